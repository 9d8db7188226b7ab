"""Loads that take effect all at once: generations of table files, checked, then switched by one pointer.

Layout under a warehouse folder::

    <root>/_current                     pointer: which generation of each table is in force
    <root>/<table>/<generation>/...     the files of one load of one table

A load writes every table into a new generation, checks it (content as
written, declared keys) and only then replaces the pointer, by one atomic
rename. Readers resolve the pointer when they open a table, so they see all
tables of the old load or all of the new one; a load that fails at any place,
a malformed last row included, leaves the old rows as they were and removes
its own files. Tables that a load does not name stay in force. The generation
before the current one is kept for readers that opened it; older ones go.

One load at a time may run on a folder; readers need no care.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "_current"


@dataclass(frozen=True)
class Reference:
    """Columns whose values, where none is null, must occur in another table of the load."""

    columns: tuple[str, ...]
    table: str
    target: tuple[str, ...]


class KeyViolation(ValueError):
    """A declared key does not hold; nothing has been published."""


# ---------------------------------------------------------------- files


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _read(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Write ``path`` by a rename over the old file, so that readers find one or the other."""
    fs, jpath = _fs(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri() if new.toUri().getScheme() else fs.getUri(),
                                                                spark._jsc.hadoopConfiguration()).rename(new, jpath, options)


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


# ---------------------------------------------------------------- the pointer


def current(spark: SparkSession, root: str) -> dict[str, dict]:
    """table -> {generation, rows, digest} of what is in force under ``root`` (empty if nothing was published)."""
    text = _read(spark, f"{root}/{POINTER}")
    return json.loads(text)["tables"] if text else {}


def resolve(spark: SparkSession, path: str) -> str:
    """The folder that holds the files of the table at ``path`` now: its published generation, or ``path`` itself."""
    root, _, table = path.rstrip("/").rpartition("/")
    entry = current(spark, root).get(table)
    return f"{path.rstrip('/')}/{entry['generation']}" if entry else path


def new_generation() -> str:
    return f"g-{uuid.uuid4().hex}"


def switch(spark: SparkSession, root: str, tables: Mapping[str, dict]) -> list[tuple[str, str]]:
    """Put the given generations in force together; remove, and return, the (table, generation) replaced before the last switch."""
    text = _read(spark, f"{root}/{POINTER}")
    old = json.loads(text) if text else {"tables": {}, "replaced": []}
    replaced = [f"{t}/{e['generation']}" for t, e in old["tables"].items() if t in tables]
    _replace(spark, f"{root}/{POINTER}", json.dumps({"tables": {**old["tables"], **tables}, "replaced": replaced}, indent=1, sort_keys=True))
    gone = [tuple(name.split("/")) for name in old["replaced"]]
    for table, generation in gone:
        remove(spark, f"{root}/{table}/{generation}")
    return gone


# ---------------------------------------------------------------- checks


def _shown(rows: list, columns: Sequence[str]) -> str:
    return ", ".join("/".join("null" if r[c] is None else repr(r[c]) for c in columns) for r in rows)


def check_key(df: DataFrame, table: str, key: Sequence[str], show: int = 5) -> None:
    """Raise ``KeyViolation`` if ``key`` is null or occurs twice; counted with partial aggregation."""
    bad = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n__")).where(" or ".join(["n__ > 1", *(f"`{c}` is null" for c in key)])).limit(show).collect()
    if bad:
        raise KeyViolation(f"Key ({', '.join(key)}) of {table} is null or repeated: {_shown(bad, key)}")


def check_reference(df: DataFrame, table: str, ref: Reference, other: DataFrame, show: int = 5) -> None:
    """Raise ``KeyViolation`` if a value is missing in the other table; distinct values meet, not rows."""
    names = [f"k{i}" for i in range(len(ref.columns))]
    mine = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(ref.columns, names)]).dropna().distinct()
    theirs = other.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(ref.target, names)])
    bad = mine.join(theirs, names, "left_anti").limit(show).collect()
    if bad:
        raise KeyViolation(f"{table} ({', '.join(ref.columns)}) refers to unknown rows of {ref.table} ({', '.join(ref.target)}): {_shown(bad, names)}")
