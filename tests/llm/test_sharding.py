import zlib

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ledgerline.llm import sharding as S
from llm.conftest import EDGE_TEXTS


def check(rows, shards, largest):
    sizes, slots = {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    mean = sum(sizes.values()) / shards
    assert all(0 <= s < shards for s in sizes) and all(abs(v - mean) <= 2 * largest for v in sizes.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    rows = S.assign(docs, 10).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert all(r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)
    check(rows, 10, max(map(len, texts.values())) + 16)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


@pytest.mark.parametrize("sample", [8000, 3])
def test_a_hot_text_is_split_and_a_poor_sample_mended(spark, sample):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy of one text " * 20))
                                    .otherwise(F.concat(F.lit("own "), F.col("id").cast("string"))).alias("text"))
    rows = S.assign(docs, 16, sample=sample).collect()
    assert len(rows) == 4000
    check(rows, 16, 400)
    assert len({r["shard"] for r in rows if r["size"] > 300}) > 5  # copies stand in neighbouring shards


def test_assignment_does_not_depend_on_the_partitioning(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    key = lambda d: sorted((r["doc_id"], r["shard"], r["slot"]) for r in S.assign(d, 7).collect())
    assert key(docs) == key(docs.repartition(9))


def test_ranges_of_tied_keys():
    splitters = [(1, 5), (1, 9), (4, 0)]
    k, t = np.array([0, 1, 1, 1, 1, 4, 9]), np.array([7, 4, 5, 8, 9, -1, 0])
    assert S.range_of(k, t, splitters).tolist() == [sum(s <= x for s in splitters) for x in zip(k.tolist(), t.tolist())]


def test_edge_rows(spark, edge_docs, no_docs):
    rows = S.assign(edge_docs, 4).collect()
    assert len(rows) == len(EDGE_TEXTS) + 3
    check(rows, 4, 200_016)
    assert S.assign(no_docs, 4).collect() == []


def test_written_shards(spark, edge_docs):
    import tempfile

    path = tempfile.mkdtemp(prefix="ledgerline-shards-") + "/out"
    S.write_shards(edge_docs, path, 3)
    back = spark.read.parquet(path)
    assert set(edge_docs.columns) | {"shard_", "slot_"} == set(back.columns)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=repr) == sorted(((r["doc_id"], r["text"]) for r in edge_docs.collect()), key=repr)


def slow_assign(rows, shards):
    """Everything sorted in one list and cut by running byte counts; hashes by another library."""
    import xxhash

    def signed(h):
        return h - (1 << 64) if h >> 63 else h

    def key(d, t):
        text = (t or "").encode()
        own = 42 if d is None else signed(xxhash.xxh64_intdigest(int(d).to_bytes(8, "little", signed=True), 42))
        return signed(xxhash.xxh64_intdigest(text, 42)), own, d is not None, d or 0

    order = sorted(rows, key=lambda r: key(*r))
    size = [len((t or "").encode()) + 16 for _, t in order]
    total, upto, out, first = sum(size), 0, [], {}
    for place, ((d, _), n) in enumerate(zip(order, size)):
        upto += n
        shard = min((2 * upto - n) * shards // (2 * total), shards - 1)
        out.append((d, n, shard, place - first.setdefault(shard, place)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"sample": 5}, {"range_rows": 20}, {"ranges_per_shard": 1}])
def test_equals_a_sort_and_cut_on_the_driver(spark, edge_docs, options):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    for frame, shards in ((docs, 40), (docs.where("doc_id < 20"), 40), (edge_docs.select("doc_id", "text"), 7)):
        got = S.assign(frame, shards, **options)
        assert sorted(((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in got.collect()), key=repr) == slow_assign([tuple(r) for r in frame.collect()], shards)


def test_ranges_follow_the_rows_and_tiny_texts_are_spread(spark):
    """A third of the rows is empty and as good as weightless in bytes; no range holds many of them."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.repeat(F.lit("x"), 900)).alias("text"))
    keys = docs.select(F.xxhash64("text").alias("k"), F.xxhash64("doc_id").alias("t"), (F.octet_length("text") + 16).cast("long").alias("size"))
    splitters, ranges = S.choose_splitters(keys, 4, range_rows=100)
    assert len(ranges) >= 60 and max(n for _, _, n in ranges) <= 4 * 100 + 1 and sum(n for _, _, n in ranges) == 6000
