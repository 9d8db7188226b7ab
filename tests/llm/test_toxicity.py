import itertools
import zlib

import numpy as np
import pytest

from ledgerline.llm import toxicity as T

MEDIUM = "/root/testdata/sf0.01"


def random_model(rng):
    return T.Model(np.zeros(1), rng.normal(size=1), rng.normal(size=(2, 2)), np.zeros(4), 0.1)


@pytest.mark.parametrize("lengths", [[1], [5, 1, 3], [6, 6]])
def test_marginals_match_enumeration(lengths):
    rng = np.random.default_rng(1)
    model, scores = random_model(rng), rng.normal(size=sum(lengths))
    first, at = np.zeros(sum(lengths), bool), 0
    want = []
    for n in lengths:
        first[at] = True
        weight, total = np.zeros(n), 0.0
        for path in itertools.product((0, 1), repeat=n):
            s = model.start[0] * path[0] + sum(scores[at + k] * y for k, y in enumerate(path)) + sum(model.step[a, b] for a, b in zip(path, path[1:]))
            total += np.exp(s)
            weight += np.exp(s) * np.array(path)
        want += (weight / total).tolist()
        at += n
    assert np.allclose(T.marginals(scores, first, model)[0], want)


def test_blocks_do_not_matter(monkeypatch):
    rng = np.random.default_rng(2)
    model, scores = random_model(rng), rng.normal(size=1000) * 3
    first = rng.random(1000) < 0.01
    first[0] = True
    whole = T.marginals(scores, first, model)[0]
    monkeypatch.setattr(T, "BLOCK", 7)
    assert np.allclose(whole, T.marginals(scores, first, model)[0])


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    scored = T.tag(docs.where("lang = 'en'"), T.fit(docs, labels), ["doc_id", "text"]).collect()
    held = [(r["score"] >= 0.5, truth[r["doc_id"]] == 1) for r in scored if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) and any(a and b for a, b in held)
    for r in scored:
        assert 0 <= r["score"] <= 1
        for s in r["spans"]:
            assert r["text"][s["begin"]:s["end"]].strip() == r["text"][s["begin"]:s["end"]] != ""


def test_held_out_rows_are_never_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", f"case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    a, b = T.fit(docs, labels), T.fit(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.doc, b.doc)


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(15)] + [(1, 0), (None, 1), (2, None)], "doc_id long, toxic int").selectExpr("*", "'z' as text")
    out = T.tag(edge_docs, T.fit(edge_docs, labels), ["doc_id"]).collect()
    assert len(out) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in out)
    kept = T.drop_toxic(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r["score"] < 0.5 for r in out)
    assert T.drop_toxic(no_docs, labels).collect() == []
    none = T.tag(edge_docs, T.fit(edge_docs, labels.where("toxic = 0")), ["doc_id"]).collect()
    assert {r["score"] for r in none} == {0.0}
    assert {r["score"] for r in T.tag(edge_docs, T.fit(edge_docs, labels.where("false")), ["doc_id"]).collect()} == {0.0}


@pytest.mark.parametrize("per_class", [T.PER_CLASS, 150])
def test_rare_families_of_every_language_are_learned(spark, per_class):
    rng = np.random.default_rng(5)
    words = {x: ["".join(rng.choice(list(letters), 6)) for _ in range(400)]
             for x, letters in (("en", "aeioubcdfg"), ("ru", "абвгдежзик"), ("el", "αβγδεζηθικ"))}
    slurs = {"en": "zzworgling", "ru": "щщумратый", "el": "ψψωφος"}
    kept = lambda i: zlib.crc32(str(i).encode()) % 5 != 0
    toxic = [i for i in range(3000) if i % 5 == 1]
    rare = {}  # of some 480 toxic training rows 6 in each rare language (1.25%), and 3 held out
    for learn, n in ((True, 6), (False, 3)):
        ids = [i for i in toxic if kept(i) == learn]
        rare |= dict.fromkeys(ids[:n], "ru") | dict.fromkeys(ids[-n:], "el")
    rows = []
    for i in range(3000):
        lang = rare.get(i, "en") if i in set(toxic) else ("en", "ru", "el")[i % 3]
        body = rng.choice(words[lang], 60).tolist()
        if i % 5 == 1:
            body[10] = body[30] = slurs[lang]
        rows.append((i, " ".join(body), lang, int(i % 5 == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = T.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), per_class=per_class)
    got = {r["doc_id"]: r["score"] >= 0.5 for r in T.tag(docs, model, ["doc_id"]).collect()}
    for lang in words:
        held = [(got[i], bool(y)) for i, _, x, y in rows if x == lang and not kept(i)]
        assert sum(y for _, y in held) >= 3 and all(a for a, y in held if y)
        assert sum(a == y for a, y in held) >= 0.98 * len(held)


def test_a_family_of_half_a_percent_is_learned_and_evidence_is_bounded(spark, monkeypatch):
    """10,000 toxic training rows, 50 of them with another slur in another script; held-out ones are found."""
    rng = np.random.default_rng(6)
    kept = lambda i: zlib.crc32(str(i).encode()) % 5 != 0
    words = {"en": ["".join(rng.choice(list("aeioubcdfg"), 6)) for _ in range(500)], "ru": ["".join(rng.choice(list("абвгдежзик"), 6)) for _ in range(500)]}
    n = 25_000
    toxic = [i for i in range(n) if i % 2]
    rare = set([i for i in toxic if kept(i)][:50] + [i for i in toxic if not kept(i)][:12])
    rows = []
    for i in range(n):
        lang = "ru" if i in rare or (i % 2 == 0 and i % 10 == 0) else "en"
        body = rng.choice(words[lang], 30).tolist()
        if i % 2:
            body[5] = body[20] = "щщумратый" if lang == "ru" else "zzworgling"
        rows.append((i, " ".join(body), i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
    assert sum(1 for i in toxic if kept(i)) >= 9_900
    model = T.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    probe = [i for i in range(n) if not kept(i) and (i in rare or i % 50 in (0, 1))]
    got = {r["doc_id"]: r["score"] >= 0.5 for r in T.tag(docs.where(docs.doc_id.isin(probe)), model, ["doc_id"]).collect()}
    assert all(got[i] for i in probe if i in rare)
    assert sum(got[i] == bool(i % 2) for i in probe) >= 0.98 * len(probe)
    # the evidence comes from a bounded number of rows a class, whatever the table
    seen = []
    monkeypatch.setattr(T, "distinct_words", lambda df, real=T.distinct_words: seen.append({r["toxic"]: r["count"] for r in df.groupBy("toxic").count().collect()}) or real(df))
    T.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), per_class=200, evidence_rows=1000)
    assert all(900 < c < 1100 for c in seen[0].values()) and set(seen[0]) == {0, 1}


def test_counts_of_words_and_beginnings_equal_a_loop(spark):
    """Documents that hold each feature, by class, near copies once, against dictionaries."""
    texts = [("ab cd ab", 1, 10), ("cd abcdef", 0, 5), ("ab cd ab", 1, 7), ("xyz", 1, 3), ("12 34", 1, 1), ("É é", 0, 2)]
    rows = spark.createDataFrame([(t, y, h) for t, y, h in texts], "text string, toxic int, h long")
    got = {r["feature"]: (r["n1"], r["n0"], r["h"]) for r in T.document_counts(T.distinct_words(rows)).collect()}
    once = [("ab cd ab", 1, 7), ("cd abcdef", 0, 5), ("xyz", 1, 3), ("É é", 0, 2)]  # of copies the smallest h; no letters, no row
    want = {}
    for t, y, h in once:
        found = {0}
        for w in set(T.TOKEN.findall(t)):
            f = T.features(w)[:T.SLOTS]
            found |= {f[0], *f[2:]}
        for f in found:
            a, b, low = want.get(f, (0, 0, np.iinfo(np.int64).max))
            want[f] = (a + y, b + 1 - y, min(low, h) if y else low)
    assert got == want
