"""SimHash near-duplicate groups with pigeonring candidate search.

A document's fingerprint has 64 bits: bit b is set if more than half of its
word shingles' XXH64 values have bit b set. Two fingerprints link if they
differ in at most ``max_bits`` = 3 bits; a group is a connected component.

Candidate search works on distinct fingerprints. The 64 bits form a ring of
four 16-bit segments. If two fingerprints differ in at most 3 bits, then
there is a segment i from which every chain of l = 1, 2, 3, 4 consecutive
segments differs in at most floor(3 l / 4) = 0, 1, 2, 3 bits (the pigeonring
principle: prefix-viable chains exist on the ring). Chains of length two are
looked up by key: segment i equal and segment i + 1 equal up to one bit, a
32-bit key per chain start. Each fingerprint is stored once per start under
its own key ("home") and visits the 16 keys that change one bit of segment
i + 1. Inside a key, home rows are compared with all rows: chain length three
(at most 2 bits) first, the full distance last.

A key's rows are compared in blocks inside tasks and only the edges of a
spanning forest leave a task, never all pairs; a key with more than
``block_rows`` rows is cut into blocks, and each pair of blocks is a task's
work of its own, so no task holds an unbounded key. Components are found by
alternating large-star and small-star steps over checkpointed edges.

Defined cases: a null text has no words; a document without words has
fingerprint zero and links like any other; fewer words than the shingle length
make one shingle of all of them; repeated rows share a fingerprint and a
group; a null doc_id never names a group unless all ids of the group are null;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

SEED = 42
SEGMENTS, WIDTH = 4, 16  # a ring of four segments gives budgets 0, 1, 2, 3 for 3 bits
_CHUNK = 1 << 16  # shingles whose bits are counted at once
LINK_SCHEMA = "a long, b long"
BROADCAST_ROWS = 4_000_000  # row numbers of eight bytes that are broadcast at most


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    # bytes.lower() changes A-Z only and bytes.split() cuts at \x20 and \x09-\x0D only
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    first = starts[: len(last)]
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for a in range(0, len(first), _CHUNK):
        hashes = b"".join([digest(flat[s:e], SEED) for s, e in zip(first[a:a + _CHUNK].tolist(), last[a:a + _CHUNK].tolist())])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)  # most significant bit first
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = counts * 2 > len(first)
    return int.from_bytes(np.packbits(set_bits).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""
    return _with_prints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "text", ["doc_id"], shingle)


def _with_prints(rows: DataFrame, text: str, keep: list[str], shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(0)]
            fp = pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], fp], [*keep, "fp"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(text, *keep).mapInArrow(run, f"{fields}, fp long")


def _chain_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint the 4 x 17 lookup keys and whether a key is its own (home).

    A key holds the chain start (2 bits), segment i and segment i + 1 (with at most one bit changed).
    """
    keys, home = [], []
    flips = np.concatenate(([0], np.left_shift(1, np.arange(WIDTH)))).astype(np.uint64)
    for i in range(SEGMENTS):
        turned = _turned(fp, i)  # segment i on top
        base = (turned >> np.uint64(32)) | np.uint64(i << 32)
        keys.append(base[:, None] ^ flips[None, :])
        home.append(np.broadcast_to(flips == 0, (len(fp), len(flips))))
    return np.concatenate(keys, axis=1), np.concatenate(home, axis=1)


def _turned(fp: np.ndarray, i) -> np.ndarray:
    shift = np.uint64(WIDTH) * np.asarray(i, np.uint64)
    back = (np.uint64(64) - shift) % np.uint64(64)
    return np.where(shift == 0, fp, (fp << shift) | (fp >> back))


def chain_rows(distinct: DataFrame) -> DataFrame:
    """(key, fp): 68 rows per distinct fingerprint; the key's lowest bit marks home rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(all_fp), 4096):
                fp = all_fp[a:a + 4096]
                keys, home = _chain_keys(fp)
                key = ((keys << np.uint64(1)) | home.astype(np.uint64)).ravel().view(np.int64)
                rows = np.repeat(fp, keys.shape[1]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(rows)], ["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def _near(a: np.ndarray, b: np.ndarray, start: np.ndarray, max_bits: int) -> np.ndarray:
    """Pigeonring check of pairs that share a chain key, then the full distance."""
    diff = a ^ b
    turned = _turned(diff, start)
    ok = np.bitwise_count(turned >> np.uint64(16)) <= 2  # chain of three segments within its budget
    ok[ok] = np.bitwise_count(diff[ok]) <= max_bits
    return ok


class _Forest:
    """Union-find over the fingerprints of one group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def group_links(fp: np.ndarray, home: np.ndarray, start: int, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among the rows of one key (home rows against all rows)."""
    forest, out, at = _Forest(len(fp)), [], np.uint64(start)
    for h in np.flatnonzero(home).tolist():
        for j in np.flatnonzero(_near(np.broadcast_to(fp[h], fp.shape), fp, at, max_bits)).tolist():
            if j != h and forest.join(h, j):
                out.append((h, j))
    return out


def _sorted_links(key: np.ndarray, fp: np.ndarray, max_bits: int, small: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the groups of a key-sorted run: shifted comparison for small groups, a forest for others."""
    group, home = key >> 1, (key & 1).astype(bool)
    cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    size = np.diff(cut)
    out_a, out_b = [], []
    size_of = np.repeat(size, size)
    fits = size_of <= small
    for s in range(1, int(min(small, size.max(initial=1)))):
        i = np.flatnonzero(fits[:-s] & (group[s:] == group[:-s]) & (home[s:] | home[:-s]))
        if not len(i):
            continue
        ok = _near(fp[i], fp[i + s], (group[i] >> 32).astype(np.uint64), max_bits)
        out_a.append(fp[i[ok]])
        out_b.append(fp[i[ok] + s])
    for g in np.flatnonzero(size > small).tolist():
        a, b = cut[g], cut[g + 1]
        links = group_links(fp[a:b], home[a:b], int(group[a]) >> 32, max_bits)
        if links:
            x, y = np.array(links).T
            out_a.append(fp[a:b][x])
            out_b.append(fp[a:b][y])
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def _edges_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack((np.minimum(a.view(np.int64), b.view(np.int64)), np.maximum(a.view(np.int64), b.view(np.int64)))), axis=1)
    pairs = pairs[:, pairs[0] != pairs[1]]
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def links(distinct: DataFrame, max_bits: int = 3, block_rows: int = 20_000) -> DataFrame:
    """(a, b) fingerprints whose links span the graph "differ in at most ``max_bits`` bits".

    Keys with more than ``block_rows`` rows take the block route; its result is as whole as that of the others.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("four segments serve at most 3 bits")
    rows = stored(chain_rows(distinct), "chains")
    group = F.shiftright("key", 1)
    # only keys with a home row and another row can link; counted before rows are brought together
    sizes = rows.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("key").bitwiseAND(1)).alias("home"))
    hot = stored(sizes.where((F.col("n") > block_rows) & (F.col("home") == 1)).select("g", "n"), "hotkeys")
    tagged = rows.withColumn("g", group)
    cold = tagged.join(hot, "g", "left_anti") if hot.head(1) else tagged

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.concatenate((key, batch.column(0).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if len(key) < 200_000:
                continue
            done = np.searchsorted(key >> 1, key[-1] >> 1)  # the last group may go on in the next batch
            if done:
                yield _edges_batch(*_sorted_links(key[:done], fp[:done], max_bits))
                key, fp = key[done:], fp[done:]
        if len(key):
            yield _edges_batch(*_sorted_links(key, fp, max_bits))

    edges = cold.repartition("g").select("key", "fp").sortWithinPartitions("key").mapInArrow(in_order, LINK_SCHEMA)
    if hot.head(1):
        edges = edges.union(_hot_links(tagged.join(hot, "g"), max_bits, block_rows))
    return edges


def _hot_links(rows: DataFrame, max_bits: int, block_rows: int) -> DataFrame:
    """Hot keys: rows dealt into ceil(n / block_rows) blocks by hash; each pair of blocks is one unit of work."""
    blocks = F.ceil(F.col("n") / F.lit(block_rows)).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("blk", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    units = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("g", F.least("blk", "other").alias("p"), F.greatest("blk", "other").alias("q"), "key", "fp")

    def unit(pdf):
        import pandas as pd

        key = pdf["key"].to_numpy()
        fp = pdf["fp"].to_numpy().view(np.uint64)
        found = np.array(group_links(fp, (key & 1).astype(bool), int(key[0] >> 33), max_bits), int).reshape(-1, 2)
        return pd.DataFrame({"a": fp[found[:, 0]].view(np.int64), "b": fp[found[:, 1]].view(np.int64)})

    return units.groupBy("g", "p", "q").applyInPandas(unit, LINK_SCHEMA)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of the component, for every node of an edge.

    Alternating large-star and small-star steps (each keeps connectivity and ends in stars); edges are
    stored after every round, so that a lost executor costs one round at most.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        met = both.join(low, "u")
        if large:
            moved = met.where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            moved = met.select(F.col("m").alias("a"), F.col("v").alias("b")).union(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return moved.where("a <> b").distinct()

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        return tuple(r)

    e = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = mark(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        e = stored(star(star(e, True), False), "stars")
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root"))


def print_roots(distinct: DataFrame, max_bits: int = 3, block_rows: int = 20_000) -> DataFrame:
    """(fp, root): the group of every distinct fingerprint."""
    roots = components(links(distinct, max_bits, block_rows))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", block_rows: int = 20_000) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row; component_id is the smallest reachable doc_id."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    member = distinct.join(print_roots(distinct, max_bits, block_rows), "fp")
    least = member.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = member.join(least, "root").select("fp", "component_id")
    # a fingerprint shared by very many documents is split by the skew-join handling; rows are narrow
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 3, block_rows: int = 20_000) -> DataFrame:
    """One row of each group, with its own columns: the smallest doc_id's (nulls last; of repeated rows any one).

    Rows are stored once with their fingerprint and a row number, so the choice is made row by row, also
    where ids repeat or are null; only the chosen numbers meet the texts again.
    """
    packed = docs.select(F.col("text").cast("string").alias("text"), F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"),
                         F.monotonically_increasing_id().alias("uid"))
    rows = stored(_with_prints(packed, "text", ["row", "id", "uid"], shingle), "printed")
    entry = F.struct(F.col("id").isNull().alias("z"), "id", "uid")
    per_print = rows.groupBy("fp").agg(F.min(entry).alias("best"), F.count(F.lit(1)).alias("n"))
    per_print = stored(per_print, "per_print")
    of_print = per_print.join(print_roots(per_print.select("fp"), max_bits, block_rows), "fp")
    groups = of_print.groupBy("root").agg(F.min("best").alias("best"), F.sum("n").alias("n")).where("n > 1").select("root", F.col("best.uid").alias("first"))
    shared = of_print.join(groups, "root").select("fp", "first")
    # numbers of the rows that go: few and narrow, unlike the rows that stay
    drop = stored(rows.select("fp", "uid").join(shared, "fp").where("uid <> first").select("uid"), "dropped")
    if drop.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(drop), "uid", "left_anti").select("row.*")
    return rows.join(drop, "uid", "left_anti").select("row.*")
