"""Periodic runs against plain Python: scans of every lag, planted tails, digests, edge rows."""

import hashlib
import random
import re
import zlib

import numpy as np

from ledgerline.llm import runs
from ledgerline.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def slow_runs(w):
    """Every maximal stretch of every lag, kept if no smaller lag is a period of it."""
    n, out = len(w), []
    for q in range(1, n // runs.TIMES + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(runs.LEAST, runs.TIMES * q):
                part = w[i:i + size]
                if all(part[d:] != part[:-d] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_tail(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def slow_row(doc_id, text):
    w = slow_tail(doc_id, WORDS.findall(text or ""))
    found = slow_runs(w)
    dropped = {i for a, n, q in found for i in range(a + q, a + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), best[0], best[1], best[2], 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{a},{n},{q}\n" for a, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_random_words_with_planted_runs_of_every_scale():
    rng = random.Random(3)
    docs = [[0] * 3000, [0, 1] * 1500, [], [1], [1] * 5, [1] * 6, [1, 2] * 3]
    for _ in range(200):
        w = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randrange(400))]
        for _ in range(rng.randrange(3)):
            p = rng.randrange(1, 90)
            block = [rng.randrange(rng.choice([1, 2, 50])) for _ in range(p)]
            at = rng.randrange(len(w) + 1)
            w[at:at] = [block[i % p] for i in range(rng.randrange(3 * p, 6 * p + 3))]
        docs.append(w)
    found = runs.find_runs(np.array([x for d in docs for x in d]), np.array([len(d) for d in docs]))
    for i, d in enumerate(docs):
        want = [(0, 3000, 1)] if i == 0 else [(0, 3000, 2)] if i == 1 else slow_runs(d)
        assert [tuple(r) for r in found[found[:, 0] == i, 1:].tolist()] == want, i


def test_long_periods_and_multiples():
    base = [i % 700 for i in range(2800)]
    for w, want in ((base, [(0, 2800, 700)]), (base[:-1], []), ([(i % 700) // 350 for i in range(2800)], None), (base + base, [(0, 5600, 700)])):
        got = [tuple(r) for r in runs.find_runs(np.array(w), np.array([len(w)]))[:, 1:].tolist()]
        assert got == (slow_runs(w) if want is None else want)


def test_the_query_equals_the_slow_version(spark, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 120))) for _ in range(150)]
    texts += [None, "", " \t", "x " * 500, "a b c " * 40, "É 日本 " * 30 + "\x0b\x0cq\r\nq", "a\x00b\x1c c\x85d " * 9]
    rows = [(i, t, "q") for i, t in enumerate(texts)] + [(None, "z " * 9, "q"), (3, texts[3], "q")]
    spark.createDataFrame(rows, "doc_id long, text string, period string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((slow_row(i, t) for i, t, _ in rows), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))) > 5  # planted tails are among them


def test_operator_on_edge_rows(spark, edge_docs, no_docs):
    found = runs.periodic_runs(edge_docs, ["doc_id", "text", "row"]).collect()
    assert len(found) == edge_docs.count()
    for r in found:
        w = WORDS.findall(r["text"] or "")
        assert r["n_words"] == len(w)
        if len(w) < 2000:
            assert [tuple(x) for x in r["runs"]] == slow_runs(w)
        else:
            assert [tuple(x) for x in r["runs"]] == [(0, len(w), 1)] and r["collapsed"] == w[0]
    assert runs.periodic_runs(no_docs, ["doc_id"]).count() == 0
    # a column named like a result is only carried when asked for
    clash = edge_docs.withColumnRenamed("row", "runs")
    assert runs.periodic_runs(clash, ["doc_id"]).columns == ["doc_id", "runs", "collapsed", "n_words"]
