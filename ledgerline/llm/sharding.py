"""Sharding by sampled splitters: size-weighted samples, quantile boundaries, range partitions, law ``bytes``.

Records are ordered by (hash of the text, hash of the id, id), so that equal
texts are neighbours. A keyed Poisson sample takes each record with a
probability proportional to its size (about ``sample`` records, or 25 a range if
that is more); weighted quantiles of the sampled keys are the boundaries of
``ranges_per_shard`` ranges per shard, or of more, so that a range holds about
``range_rows`` of the narrow rows that are numbered in one task. Exact sizes of the ranges are then
summed, and a range with more than twice the mean is subdivided with a sample
of its own until none is left that can be split, also inside a hot text,
whose copies differ in the id's hash.

A record's place is its range's offset plus a running sum inside the range, so
shards are consecutive pieces of the total order whose byte counts differ from
the mean by less than the two records at their ends, on every table and for
any sample; no text is moved for the assignment. Slots count from 0 in that
order. The driver sees the samples, the ranges and the shards: a row for some
``range_rows / 25`` records at most.

Defined cases: a null text has 16 bytes and the checksum of the empty text; a
null id is an id of its own; repeated rows get neighbouring slots (rows that agree
in text and id are one key, which no boundary can split: they are numbered in one task); an empty
table gives an empty result; there may be fewer records than shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import fresh, stored

LAW, OVERHEAD = "bytes", 16
SAMPLE, RANGES_PER_SHARD, RANGE_ROWS, SEED = 8000, 8, 1_000_000, 5
_UNIT = float(1 << 53)


def _draw(rows: DataFrame, chance, seed: int) -> DataFrame:
    """Keyed Poisson sample: the same rows are drawn on every run and after every retry."""
    u = F.pmod(F.xxhash64(F.lit(seed), "k", "t"), F.lit(1 << 53)) / F.lit(_UNIT)
    return rows.where(u < chance)


def _splitters(sample: list[tuple[int, int, float]], pieces: int) -> list[tuple[int, int]]:
    """Keys at the weighted quantiles 1/pieces, ..., (pieces - 1)/pieces of (key, key, weight) rows."""
    rows = sorted(sample)
    if not rows or pieces < 2:
        return []
    upto = np.cumsum([w for _, _, w in rows])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, pieces) / pieces)
    return sorted({rows[i][:2] for i in np.minimum(at, len(rows) - 1).tolist()})


def range_of(k: np.ndarray, t: np.ndarray, splitters: list[tuple[int, int]]) -> np.ndarray:
    """Number of splitters that are at most the key (k, t)."""
    if not splitters:
        return np.zeros(len(k), np.int32)
    sk, st = (np.array(x, np.int64) for x in zip(*splitters))
    low, high = np.searchsorted(sk, k, "left"), np.searchsorted(sk, k, "right")
    out = low.copy()
    tied = np.flatnonzero(high > low)
    for a, b in set(zip(low[tied].tolist(), high[tied].tolist())):
        rows = tied[low[tied] == a]
        out[rows] = a + np.searchsorted(st[a:b], t[rows], "right")
    return out.astype(np.int32)


def _ranged(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(splitters)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = range_of(b.column("k").to_numpy(zero_copy_only=False), b.column("t").to_numpy(zero_copy_only=False), shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r, pa.int32())], [*names, "r"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, r int")


def choose_splitters(keys: DataFrame, shards: int, sample: int = SAMPLE, ranges_per_shard: int = RANGES_PER_SHARD,
                     seed: int = SEED, max_rounds: int = 8, range_rows: int = RANGE_ROWS) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """(splitters, [(range, bytes, rows)]) over ``keys`` (k, t, size), after overfull ranges are subdivided.

    A record weighs its size plus the mean size, so a range of twice the mean weight has at most four times the mean bytes
    and four times the mean rows.
    """
    total, n = keys.agg(F.sum("size"), F.count(F.lit(1))).head()
    if not total:
        return [], []
    pieces = max(shards * ranges_per_shard, -(-n // range_rows))
    sample = max(sample, 25 * -(-n // range_rows))
    mean = -(-total // n)
    keys, whole = keys.select("k", "t", "size", (F.col("size") + mean).alias("w")), total + n * mean
    target = whole / pieces
    drawn = _draw(keys, F.lit(sample / whole) * F.col("w"), seed).select("k", "t", "w").collect()
    splitters = _splitters([(r["k"], r["t"], max(r["w"], whole / sample)) for r in drawn], pieces)
    for turn in range(max_rounds + 1):
        ranged = _ranged(keys, splitters)
        sums = {r["r"]: r for r in ranged.groupBy("r").agg(F.sum("size").alias("bytes"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect()}
        over = {x: s["w"] for x, s in sums.items() if s["w"] > 2 * target and s["n"] > 1}
        if not over or turn == max_rounds:
            break
        weight = F.lit(64.0 / target) * F.col("w")
        again = _draw(ranged.where(F.col("r").isin(list(over))), weight, seed + 1 + turn).select("r", "k", "t", "w").collect()
        added = {s for x, b in over.items() for s in _splitters(
            [(r["k"], r["t"], max(r["w"], target / 64)) for r in again if r["r"] == x], int(np.ceil(b / target)))}
        grown = sorted(set(splitters) | added)
        if grown == splitters:
            break  # what is left are single keys
        splitters = grown
    return splitters, [(x, s["bytes"], s["n"]) for x, s in sorted(sums.items())]


def assign(docs: DataFrame, shards: int = 40, keep: list[str] | None = None, **options) -> DataFrame:
    """``keep`` columns (doc_id) of every row plus size, text_crc32, law, shard, slot and grown_shard."""
    spark = docs.sparkSession
    keep = ["doc_id"] if keep is None else keep
    names = [f"c{i}" for i in range(len(keep))]  # the caller's columns stay out of the way of size, k, t and r
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.xxhash64(text).alias("k"), F.xxhash64("doc_id").alias("t"),
                       (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
                       F.crc32(text.cast("binary")).alias("crc"), F.col("doc_id").alias("id"))
    rows = stored(rows, "keys")
    splitters, ranges = choose_splitters(rows, shards, **options)
    total = sum(b for _, b, _ in ranges)
    before_bytes, before_rows, offsets = 0, 0, []
    for x, b, n in ranges:
        offsets.append((x, before_bytes, before_rows))
        before_bytes, before_rows = before_bytes + b, before_rows + n
    start = spark.createDataFrame(offsets, "r int, bytes_before long, rows_before long")  # one row per range
    inside = Window.partitionBy("r").orderBy("k", "t", "id")
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = _ranged(rows, splitters).withColumns({"upto": F.sum("size").over(run), "place": F.row_number().over(inside)}) \
        .join(F.broadcast(start), "r")
    middle = 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")
    placed = placed.withColumns({
        "shard": F.least(F.call_function("div", middle * F.lit(shards), F.lit(max(2 * total, 1))), F.lit(shards - 1)).cast("int"),
        "row": F.col("rows_before") + F.col("place") - 1})
    placed = stored(placed.select(*names, "size", "crc", "shard", "row"), "placed")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    out = placed.join(F.broadcast(first), "shard")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"),
                      "shard", (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, **options) -> None:
    """Write ``docs`` as one Parquet folder per shard under ``path`` (columns shard_ and slot_ say the place)."""
    shard, slot = fresh(docs, "shard_", "slot_")
    packed = docs.withColumn(fresh(docs, "row_")[0], F.struct(*docs.columns))
    row = packed.columns[-1]
    out = assign(packed, shards, [row], **options)
    out.select(f"{row}.*", F.col("shard").alias(shard), F.col("slot").alias(slot)).write.partitionBy(shard).parquet(path)
