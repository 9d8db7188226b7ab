import re
from collections import Counter

import pytest
from conftest import SMALL

from ledgerline.llm import quality as Q
from ledgerline.llm.common import stored


def brute(text):
    text = text or ""
    words = re.findall("[^\\x20\\x09-\\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\\x20\\x09-\\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines),
            sum(c.isupper() for c in text))


def compare(docs):
    rows = Q.measures(docs.select("text")).collect()
    assert rows and [tuple(r[c] for c in Q.MEASURES) for r in rows] == [brute(r["text"]) for r in rows]


def test_measures_match_brute_force(spark, edge_docs):
    compare(spark.read.parquet(f"{SMALL}/documents.parquet"))
    compare(edge_docs)


@pytest.mark.parametrize("bits", [2, 58, 62])
def test_hash_collisions_and_long_texts_stay_exact(spark, edge_docs, monkeypatch, bits):
    monkeypatch.setattr(Q, "_POSITION_BITS", bits)  # few position bits: every window; few hash bits: many collisions
    compare(spark.read.parquet(f"{SMALL}/documents.parquet").limit(60))


def test_bucket_keeps_six_digits(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 5000).select("id", Q.bucket(F.col("id")).alias("b")).collect()
    for r in rows:
        step = max(r["id"].bit_length() - 6, 0)
        assert r["b"] == r["id"] >> step << step


def test_sketches_merge(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    m = stored(Q.measures(docs), "measured")
    whole = {tuple(r) for r in Q.sketches(m).collect()}
    a, b = Q.sketches(m.where("doc_id % 2 = 0")), Q.sketches(m.where("doc_id % 2 = 1"))
    assert {tuple(r) for r in Q.merged(a.unionByName(b), "lang", "source").select("lang", "source", "rule", "value", "n").collect()} == whole


def test_edge_rows(edge_docs, no_docs):
    out = Q.quality(edge_docs).collect()
    assert len(out) == edge_docs.count() and not any(r["kept"] for r in out if r["base_failed"])
    assert {r["doc_id"]: r["n_words"] for r in out}[0] == 0  # the null text
    kept = Q.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r["kept"] for r in out)
    assert Q.quality(no_docs).collect() == [] and Q.keep_good(no_docs).collect() == []


def test_junk_goes_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.quality(docs).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    assert not any(r["kept"] for r in rows if r["quality"] == 0)


def test_a_third_of_junk_copies_goes(spark):
    """Copies, and different junk texts, of a third of a (lang, source) move no cutoff; the clean two thirds stay."""
    import random

    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(3000)]
    clean = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(60, 90))) + rng.choice(["", " #x"])
    junk = lambda: " ".join(rng.choice(words) + "####" for _ in range(70))
    copy = junk()
    rows = [(i, clean(), "en", "web") for i in range(600)] + [(600 + i, copy, "en", "web") for i in range(300)]
    rows += [(1000 + i, clean(), "en", "blog") for i in range(600)] + [(1600 + i, junk(), "en", "blog") for i in range(300)]
    kept = {r["doc_id"]: r["kept"] for r in Q.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(kept[i] for i in kept if i % 1000 >= 600)
    assert all(kept[i] for i in kept if i % 1000 < 600)
