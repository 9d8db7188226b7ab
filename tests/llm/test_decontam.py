import hashlib
import re

import pytest
from conftest import SMALL

from ledgerline.llm import decontam as D
from llm.conftest import as_rows


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)


def brute(docs, items):
    windows = []
    for i, t in items:
        w = words(t)
        if w:  # all items without an id are one
            windows += [(None if i is None else str(i), tuple(w[k:k + 10])) for k in range(max(1, len(w) - 9))]
    sizes, owners = {len(win) for _, win in windows}, {}
    for i, win in windows:
        owners.setdefault(win, set()).add(i)
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in owners:
                    hit.update(range(k, k + n))
                    found |= owners[tuple(w[k:k + n])]
        yield d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found - {None})).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("limit", [50_000_000, 3000])
def test_matches_brute_force(spark, limit):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 20000")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = as_rows(D.digest(D.contamination(docs, items, max_automaton_chars=limit)))
    want = sorted(brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()]), key=repr)
    assert got == want and any(r[-1] for r in got)


def test_edge_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "One, two!"), (2, None), (3, "..."), (None, "one"), (4, "three"), (4, "three"), (5, "日本語")], "item_id long, text string")
    got = as_rows(D.digest(D.contamination(edge_docs, items)))
    want = sorted(brute([(r["doc_id"], r["text"]) for r in edge_docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()]), key=repr)
    assert got == want
    assert as_rows(D.digest(D.contamination(no_docs, items))) == []
    none = D.digest(D.contamination(edge_docs, items.where("false"))).collect()
    assert len(none) == edge_docs.count() and not any(r["contaminated"] for r in none)
    kept = D.drop_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == sum(not r[-1] for r in want)


def test_spans_point_into_the_original(spark):
    text = "Intro. ONE --- two;three four five six seven eight nine TEN eleven, done"
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    row = D.contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), items).head()
    assert [(s["begin"], s["end"]) for s in row["spans"]] == [(text.index("ONE"), text.index(", done"))]
    assert [(h["first"], h["last"]) for h in row["hits"]] == [(1, 12)]


def test_items_without_an_id_mark_words_as_the_statement_says(spark, tmp_path):
    import duckdb
    from ledgerline.llm.oracle import ORACLE
    from ledgerline.llm.queries import QUERIES
    from test_oracle import _arrow, _rows

    docs = spark.createDataFrame([(1, "x one two three y"), (2, "one two"), (3, "four"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, "one two three"), (None, "four"), (7, "one"), (None, None)], "item_id long, text string")
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = QUERIES["op7_decontamination"](spark, str(tmp_path))
    assert {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in got.collect()} == {1: (3, 2, True), 2: (1, 1, True), 3: (1, 1, True), 4: (0, 0, False)}
    assert _rows(got.toArrow()) == _rows(_arrow(con.sql(ORACLE["op7_decontamination"])))


def test_memory_at_the_bound():
    """An automaton at the documented bound, in a process of its own."""
    import subprocess
    import sys

    code = """
import random, resource
from ledgerline.llm import decontam as D
rng, pairs, size = random.Random(1), [], 0
while size < D.MAX_AUTOMATON_CHARS:
    text = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(40))
    for w in D.windows_of(text):
        pairs.append((str(len(pairs)), w))
        size += len(w) + len(pairs[-1][0])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
D.build_automaton(pairs)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=True)
    assert int(done.stdout) < 400  # MB
