"""WARC archives as a PySpark data source (format name ``warc``), reading and writing.

Writing: every task writes ``.warc.gz`` files, one gzip member per record,
rolled at ``maxFileBytes``. Each member carries the skip lengths of the WARC
standard's gzip annex (extra field "sl"), so a reader can pass over a record
without inflating it. The driver commits by writing ``_MANIFEST``, the list of
files of the successful tasks; files of lost or repeated tasks are never read.

Reading: a partition is a list of whole files of about ``partitionBytes``.
For each record the reader inflates only as far as the end of the WARC header
block, parses it, tests the pushed predicates (equality, membership, nulls,
order and string prefixes, suffixes or parts on any header column), and inflates the payload
only if the record is wanted and the schema asks for ``payload``; otherwise it
seeks to the next record. Plain ``.warc`` files and members without skip
lengths are read too. Columns: see ``SCHEMA``; a schema with fewer columns may
be given. A file that ends inside a record raises an error.

``archive`` turns (id, url, content) rows into records: of the rows with equal
payloads, the one with the largest id is a response, the others are revisits
that refer to it and hold no payload. Defined cases: null content is an empty
payload; a null url is left out; line breaks in header values become spaces;
rows that repeat the largest id are all responses, and so are rows without id
in a group without any id; an empty table gives no files.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from ledgerline.llm.common import file_system, stored

SCHEMA = ("record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
          "payload_length long, headers map<string,string>, payload binary")
# fixed values of the WARC standard
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
MANIFEST = "_MANIFEST"
BROADCAST_COPIES = 1_000_000  # repeated payloads whose (digest, id) are broadcast, some 100 MB; more are joined by a shuffle
_BREAKS = re.compile("[\\x00-\\x1f\\x7f]+")


# ---------------------------------------------------------------- records

def record_bytes(row: dict, date: str) -> bytes:
    """One record: WARC header block, HTTP header block, payload (left out of revisits)."""
    payload = row.get("payload") or b""
    length = row["payload_length"] if row.get("payload_length") is not None else len(payload)
    revisit = row["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http if revisit else http + payload
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row.get("record_id")), ("WARC-Date", date),
            ("WARC-Target-URI", row.get("target_uri")), ("WARC-Refers-To", row.get("refers_to")),
            ("WARC-Profile", PROFILE if revisit else None),
            ("WARC-Payload-Digest", row.get("payload_digest")),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {_BREAKS.sub(' ', v)}\r\n" for k, v in head if v is not None)
    return VERSION + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """A gzip member with the "sl" extra field (compressed and plain length) where 32 bits hold them."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    total = 12 + 12 + len(body) + 8
    if max(total, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, total, len(data))
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra + body + tail


def parse_header(block: bytes) -> dict[str, str]:
    """Header fields of a WARC header block (the first line names the version)."""
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and out:  # folded line
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            out[name.strip()] = value.strip()
    return out


class _Plain:
    """A record in an uncompressed file: reads up to the header's end, then on demand."""

    def __init__(self, file, at: int):
        self.file, self.at, self.buffer = file, at, b""

    def more(self) -> bool:
        self.file.seek(self.at + len(self.buffer))
        got = self.file.read(16384)
        self.buffer += got
        return bool(got)

    def up_to(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        return self.buffer[:n]

    def next(self, size: int) -> int:
        return self.at + size


class _Member:
    """A record in its own gzip member, inflated step by step."""

    def __init__(self, file, at: int):
        self.file, self.at, self.buffer = file, at, b""
        file.seek(at)
        head = file.read(12)
        self.skip = None
        if len(head) == 12 and head[3] & 4:
            extra, k = file.read(struct.unpack("<H", head[10:])[0]), 0
            while k + 4 <= len(extra):
                n = struct.unpack("<H", extra[k + 2:k + 4])[0]
                if extra[k:k + 2] == b"sl" and n == 8:
                    self.skip = struct.unpack("<I", extra[k + 4:k + 8])[0]
                k += 4 + n
        self.z, self.read_to = zlib.decompressobj(31), at

    def more(self, step: int = 16384) -> bool:
        if self.z.eof:
            return False
        if self.z.unconsumed_tail:
            data = self.z.unconsumed_tail
        else:
            self.file.seek(self.read_to)
            data = self.file.read(step)
            self.read_to += len(data)
            if not data:
                raise ValueError(f"the file ends inside the record at byte {self.at}")
        self.buffer += self.z.decompress(data, step)
        return True

    def up_to(self, n: int) -> bytes:
        step = max(16384, min(n, 1 << 24))
        while len(self.buffer) < n and self.more(step):
            pass
        return self.buffer[:n]

    def next(self, size: int) -> int:
        if self.skip is not None:
            return self.at + self.skip
        while not self.z.eof:
            self.buffer = b""
            self.more(1 << 20)
        return self.read_to - len(self.z.unused_data)


def records(file, size: int, wanted, with_payload: bool) -> Iterator[dict]:
    """Records of one open file that satisfy ``wanted(columns)``, which sees the header columns only."""
    at = 0
    while at < size:
        file.seek(at)
        magic = file.read(2)
        if magic in (b"\r\n", b"\n\r", b"\n\n"):  # spare line ends between plain records
            at += 2
            continue
        rec = _Member(file, at) if magic == b"\x1f\x8b" else _Plain(file, at)
        end = -1
        while end < 0:
            grown = rec.more()
            end = rec.buffer.find(b"\r\n\r\n")
            if end < 0 and not grown:
                raise ValueError(f"the file ends inside the record at byte {at}")
        head = parse_header(rec.buffer[:end])
        length, body = int(head.get("Content-Length", 0)), end + 4
        row = {c: head.get(f) for c, f in _FIELDS.items()}
        row["headers"] = list(head.items())
        http = head.get("Content-Type", "").startswith("application/http")
        skip = 0
        if http:
            n = 1024
            while (cut := rec.up_to(body + min(n, length)).find(b"\r\n\r\n", body, body + length)) < 0 and n < length:
                n *= 4
            skip = cut + 4 - body if cut >= 0 else 0
            said = re.search(rb"(?i)\r\nContent-Length:[ \t]*(\d+)", rec.buffer[body:body + skip])
            row["payload_length"] = int(said[1]) if said else length - skip
        else:
            row["payload_length"] = length
        if wanted(row):
            if with_payload:
                data = rec.up_to(body + length)
                if len(data) < body + length:
                    raise ValueError(f"the file ends inside the record at byte {at}")
                row["payload"] = data[body + skip:]
            yield row
        at = rec.next(body + length + 4)


# ---------------------------------------------------------------- data source

@dataclass
class _Files(ds.InputPartition):
    files: list


@dataclass
class _Written(ds.WriterCommitMessage):
    files: list


def _test(f: ds.Filter):
    """A predicate on the header columns for a pushed filter, or None if it is not supported."""
    column = f.attribute[0] if getattr(f, "attribute", None) else None
    if isinstance(f, ds.Not):
        inner = f.child
        if isinstance(inner, (ds.EqualTo, ds.In)) and _test(inner):
            name, test = inner.attribute[0], _test(inner)
            return lambda row: row[name] is not None and not test(row)
        return None
    if column not in {*_FIELDS, "payload_length"} or len(f.attribute) != 1:
        return None
    if isinstance(f, ds.IsNull):
        return lambda row: row[column] is None
    if isinstance(f, ds.IsNotNull):
        return lambda row: row[column] is not None
    if isinstance(f, ds.EqualNullSafe):
        return lambda row: row[column] == f.value
    kinds = {ds.EqualTo: lambda a: a == f.value, ds.In: lambda a: a in f.value, ds.GreaterThan: lambda a: a > f.value,
             ds.GreaterThanOrEqual: lambda a: a >= f.value, ds.LessThan: lambda a: a < f.value,
             ds.LessThanOrEqual: lambda a: a <= f.value, ds.StringStartsWith: lambda a: a.startswith(f.value),
             ds.StringEndsWith: lambda a: a.endswith(f.value), ds.StringContains: lambda a: f.value in a}
    kind = kinds.get(type(f))
    return None if kind is None else lambda row: row[column] is not None and kind(row[column])


class WarcReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.fieldNames()
        unknown = set(self.columns) - {*_FIELDS, "payload_length", "headers", "payload"}
        if unknown:
            raise ValueError(f"no such WARC columns: {sorted(unknown)}")
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionbytes", 64 << 20))
        self.filters: list = []

    def pushFilters(self, filters):
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self):
        from pyarrow import fs

        store, path = file_system(self.path)
        info = store.get_file_info(f"{path}/{MANIFEST}")
        if info.type == fs.FileType.File:
            with store.open_input_file(info.path) as f:
                files = [(f"{path}/{name}", size) for name, size in json.loads(f.read())]
        else:
            found = store.get_file_info(fs.FileSelector(path, recursive=True)) if store.get_file_info(path).type == fs.FileType.Directory else [store.get_file_info(path)]
            files = sorted((i.path, i.size) for i in found if i.type == fs.FileType.File and re.search(r"\.warc(\.gz)?$", i.path))
        parts, now, total = [], [], 0
        for f in files:
            if now and total + f[1] > self.partition_bytes:
                parts.append(_Files(now))
                now, total = [], 0
            now.append(f)
            total += f[1]
        return [*parts, _Files(now)]

    def read(self, partition):
        tests = [_test(f) for f in self.filters]
        store, _ = file_system(self.path)
        types = {"payload_length": pa.int64(), "payload": pa.binary(), "headers": pa.map_(pa.string(), pa.string())}
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], types.get(c, pa.string())) for c in self.columns], self.columns)

        for path, size in partition.files:
            with store.open_input_file(path) as file:
                for row in records(file, size, lambda r: all(t(r) for t in tests), "payload" in self.columns):
                    rows.append(row)
                    held += 500 + len(row.get("payload") or b"")
                    if held > 8 << 20:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.max_bytes = int(options.get("maxfilebytes", 64 << 20))
        self.date = options.get("date", "2024-01-01T00:00:00Z")

    def write(self, iterator):
        store, path = file_system(self.path)
        store.create_dir(path, recursive=True)
        files, out, name, size = [], None, "", 0
        for batch in iterator:
            columns = batch.schema.names
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for values in zip(*(part.column(i).to_pylist() for i in range(len(columns)))):
                    if out is None:
                        name, size = f"records-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    size += out.write(gzip_member(record_bytes(dict(zip(columns, values)), self.date)))
                    if size >= self.max_bytes:
                        out.close()
                        files.append((name, size))
                        out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return _Written(files)

    def commit(self, messages):
        store, path = file_system(self.path)
        store.create_dir(path, recursive=True)
        known = []
        if store.get_file_info(f"{path}/{MANIFEST}").is_file:
            with store.open_input_file(f"{path}/{MANIFEST}") as f:
                known = json.loads(f.read())
        with store.open_output_stream(f"{path}/{MANIFEST}", compression=None) as f:
            f.write(json.dumps(known + sorted(x for m in messages if m is not None for x in m.files)).encode())

    def abort(self, messages):
        store, path = file_system(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else []:
                store.delete_file(f"{path}/{name}")


class WarcSource(ds.DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are added to, not overwritten; choose a new path")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_warc(records_df: DataFrame, path: str, **options) -> None:
    """Write record rows (the columns of ``SCHEMA`` but headers) as archives under ``path``."""
    register(records_df.sparkSession)
    records_df.write.format("warc").mode("append").options(**options).save(path)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, **options) -> DataFrame:
    """Records under ``path``; without ``payload`` among ``columns`` no payload is inflated."""
    register(spark)
    reader = spark.read.format("warc").options(**options)
    if columns is not None:
        full = StructType.fromDDL(SCHEMA)
        reader = reader.schema(StructType([full[c] for c in columns]))
    return reader.load(path)


# ---------------------------------------------------------------- pages

def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four base-32 digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    # fixed values: the digits of base 32 and the alphabet of RFC 4648
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", content_col: str = "html", **options) -> None:
    """One record per row under ``path``; repeated payloads become revisits of the row with the largest id."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("target_uri"),
                        F.encode(F.coalesce(F.col(content_col), F.lit("")), "UTF-8").alias("payload")) \
        .withColumn("digest", sha1_base32(F.col("payload")))
    # only (digest, id) is shuffled, and payloads once if very many of them are repeated; a hot payload is one row per task
    # after partial aggregation
    same = stored(rows.groupBy("digest").agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "copies")
    same = same.withColumnRenamed("digest", "d")
    met = rows.join(F.broadcast(same) if same.count() <= BROADCAST_COPIES else same, F.col("digest") == F.col("d"), "left")
    revisit = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    out = met.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), page_urn(F.col("id")).alias("record_id"), "target_uri",
        F.when(revisit, page_urn(F.col("original"))).alias("refers_to"), F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"), F.when(~revisit, F.col("payload")).alias("payload"))
    write_warc(out, path, **options)
