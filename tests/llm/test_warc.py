import base64
import glob
import gzip
import hashlib
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import warc as W


def folder():
    return os.path.join(tempfile.mkdtemp(prefix="ledgerline-warc-"), uuid.uuid4().hex)


def pages(spark):
    same = "<p>same</p>"
    return spark.createDataFrame(
        [(1, "http://a/1", same), (5, "http://b/5", same), (3, None, same), (7, "http://c/\r\nX: y", None), (8, "http://c/8", ""),
         (9, "http://d/é", "ü" * 70_000), (None, "http://n", "null id"), (10, "http://e", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n"),
         (11, "http://f", "twice"), (11, "http://f", "twice"), (None, "http://g", same)], "page_id long, url string, html string") \
        .withColumns({"payload": F.lit("p"), "digest": F.lit("d"), "record_type": F.lit("r"), "n": F.lit(1)})


def test_archives_read_back(spark):
    path, rows = folder(), pages(spark)
    W.archive(rows, path, maxFileBytes=2000)
    got = W.read_warc(spark, path).collect()
    assert len(got) == 11
    by = {}
    for r in got:
        by.setdefault(r["record_id"], []).append(r)
    want = {i: (h or "").encode() for i, h in rows.select("page_id", "html").collect()}
    for i, body in want.items():
        if i is None:
            continue
        for r in by[f"<urn:page:{i}>"]:
            assert r["payload_length"] == len(body)
            assert r["payload_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
            assert bytes(r["payload"]) == (b"" if r["record_type"] == "revisit" else body)
    kind = {k: {(r["record_type"], r["refers_to"]) for r in v} for k, v in by.items()}
    five = "<urn:page:5>"
    assert kind["<urn:page:1>"] == kind["<urn:page:3>"] == {("revisit", five)} and kind[five] == {("response", None)}
    assert kind["<urn:page:7>"] == {("revisit", "<urn:page:8>")} and kind["<urn:page:11>"] == {("response", None)}
    assert kind["<urn:page:>"] == {("response", None), ("revisit", five)}
    assert {r["target_uri"] for r in by["<urn:page:7>"]} == {"http://c/ X: y"} and by["<urn:page:3>"][0]["target_uri"] is None
    assert len(glob.glob(f"{path}/*.warc.gz")) > 1


def test_predicates_are_pushed_and_payloads_skipped(spark):
    path = folder()
    W.archive(pages(spark), path)
    heads = W.read_warc(spark, path, ["record_type", "record_id", "target_uri", "payload_length"])
    some = heads.where((F.col("record_type") == "response") & F.col("target_uri").startswith("http://d") & (F.col("payload_length") > 10))
    assert "PushedFilters: [" in some._jdf.queryExecution().executedPlan().toString() or "BatchScan" in some._jdf.queryExecution().executedPlan().toString()
    assert [r["record_id"] for r in some.collect()] == ["<urn:page:9>"]
    assert heads.where("record_type <> 'response'").count() == 4 and heads.where("target_uri is null").count() == 1
    file = glob.glob(f"{path}/*.warc.gz")[0]

    class Counting:
        def __init__(self):
            self.f, self.n = open(file, "rb"), 0

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            out = self.f.read(n)
            self.n += len(out)
            return out

    light, full = Counting(), Counting()
    size = os.path.getsize(file)
    a = list(W.records(light, size, lambda r: False, True))
    b = list(W.records(full, size, lambda r: True, True))
    assert a == [] and b and light.n <= full.n


def test_plain_files_and_members_without_skip_lengths(spark):
    path = folder()
    os.makedirs(path)
    rows = [{"record_type": "response", "record_id": f"<urn:x:{i}>", "payload": b"p" * i, "payload_digest": None} for i in range(5)]
    parts = [W.record_bytes(r, "2024-01-01T00:00:00Z") for r in rows]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    with open(f"{path}/a.warc", "wb") as f:
        f.write(info + b"".join(parts))
    with open(f"{path}/b.warc.gz", "wb") as f:
        f.write(b"".join(gzip.compress(p) for p in [info, *parts]))
    got = W.read_warc(spark, path).collect()
    assert sorted(r["payload_length"] for r in got if r["record_type"] == "response") == sorted(2 * list(range(5)))
    assert [r["record_type"] for r in got].count("warcinfo") == 2
    assert W.read_warc(spark, path, partitionBytes=1).rdd.getNumPartitions() == 2


def test_a_cut_file_raises(spark):
    path = folder()
    os.makedirs(path)
    whole = W.record_bytes({"record_type": "response", "record_id": "x", "payload": os.urandom(90_000)}, "2024-01-01T00:00:00Z")
    for name, data in (("a.warc", whole[:-500]), ("b.warc.gz", W.gzip_member(whole)[:-500])):
        with open(f"{path}/{name}", "wb") as f:
            f.write(data)
        with open(f"{path}/{name}", "rb") as f, pytest.raises(ValueError):
            list(W.records(f, len(data), lambda r: True, True))


def test_empty_table_and_appending(spark):
    path = folder()
    W.archive(pages(spark).where("false"), path)
    assert W.read_warc(spark, path).collect() == []
    W.archive(pages(spark), path)
    assert W.read_warc(spark, path).count() == 11


def test_unlisted_files_are_not_read(spark):
    path = folder()
    W.archive(pages(spark), path)
    with open(f"{path}/lost-attempt.warc.gz", "wb") as f:
        f.write(b"half a record")
    assert W.read_warc(spark, path).count() == 11
