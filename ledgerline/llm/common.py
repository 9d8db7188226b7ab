"""Shared helpers of the training-data operators: table reading, scratch tables, Arrow plumbing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

# fixed values: the six white-space characters that end a word, as a character class
SPACES = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package (a zip through ``addPyFile``), once per application."""
    sc, mark = spark.sparkContext, "_ledgerline_shipped"
    if getattr(sc, mark, None) == sc.applicationId:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-py-"), "ledgerline.zip")  # Spark copies it to its file server
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    setattr(sc, mark, sc.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the session's checkpoint folder, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the application ends (until then lazily built results may read it)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)


def drop(spark: SparkSession, path: str) -> None:
    """Remove the stored table at ``path``, which nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again.

    Cuts the lineage with files that survive a lost executor, keeps columnar
    pruning, and gives Catalyst the real size of the rows, so that a small
    table is broadcast by the session's byte threshold and a large one is not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    drop_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names not taken in ``df``: each of ``names``, with underscores added as needed."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_remainder(column: str, k: int) -> Column:
    """crc32 of the id written as text, modulo ``k`` (a null id counts as remainder 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(k)), F.lit(0)).cast("int")


def per_batch(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """mapInArrow with one function per task: ``make`` runs once in the worker, its result on every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            step = step or make()
            yield step(batch)

    return df.mapInArrow(run, schema)


def pieces_of(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) over consecutive items whose sizes add up to about ``limit`` (at least one item each)."""
    a = total = 0
    for i, s in enumerate(sizes):
        if i > a and total + s > limit:
            yield a, i
            a, total = i, 0
        total += s
    if a < len(sizes):
        yield a, len(sizes)


def file_system(uri: str):
    """(pyarrow file system, path) of a local path or any URI that pyarrow opens (file, hdfs, s3, gs)."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + os.path.abspath(uri.removeprefix("file:"))
    return fs.FileSystem.from_uri(uri)
