"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, text scanned once.

Words: A-Z lower-cased, then maximal runs of digits, a-z and non-ASCII
characters. An item's windows are its runs of ``window`` consecutive words; an
item with fewer words, but not none, is one window of all its words. Windows
are put into one automaton as " w1 w2 ... "; a document is normalised to the
same form, scanned once, and every occurrence (overlapping ones too) marks its
words. Marked words are mapped back to character offsets of the original text.

The automaton is shared with every task, so its size is checked: it takes up to
some 40 bytes of a worker's memory for each byte of windows, so the bound of five million bytes
is some 200 MB. An item table whose windows exceed ``max_automaton_chars`` is cut
by hash into parts that each stay below it; the documents are then scanned once per part and the
marked words united, so the result does not depend on the limit.

Defined cases: a null text has no words and no hits; an item that is null or
without words has no window; equal windows of several items count for each of
them; items with a null id are one item: its windows mark words and it counts among
the items, but an id list leaves it out; repeated rows give repeated results; empty tables give no hits; other
columns are ignored or kept, never read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, pieces_of, scratch_path, stored

MAX_AUTOMATON_CHARS = 5_000_000  # bytes of windows and ids in one automaton
# fixed values: what is not a word character among the ASCII characters (after lower-casing)
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
_NOT_WORD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The normalised words as UTF-8; a byte above 0x7F always belongs to a word, so bytes suffice."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_NOT_WORD).split()


def windows_of(text: str | None, window: int = 10) -> set[bytes]:
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))}


def item_windows(items: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id string, win binary): the distinct windows of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wins = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in windows_of(t, window):
                    ids.append(i)
                    wins.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(wins, pa.binary())], ["item_id", "win"])

    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "item_id string, win binary").distinct()


def build_automaton(pairs: list[tuple[str | None, bytes]]) -> ahocorasick.Automaton:
    """Automaton over " win " (as Latin-1, one character per byte); a value is (length, words, item ids)."""
    ids = defaultdict(list)
    for item, win in pairs:
        ids[win].append(item)
    machine = ahocorasick.Automaton()
    for win, owners in ids.items():
        key = b" " + win + b" "
        machine.add_word(key.decode("latin-1"), (len(key), win.count(b" ") + 1, tuple(owners)))
    if ids:
        machine.make_automaton()
    return machine


def scan(words: list[bytes], machine: ahocorasick.Automaton) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit word ranges [first, last) of every window occurrence, merged, and the items they belong to."""
    if not words or not len(machine):
        return [], set()
    flat = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found = list(machine.iter(flat))
    if not found:
        return [], set()
    starts = np.cumsum([1] + [len(w) + 1 for w in words[:-1]])
    ranges, items = [], set()
    first = np.searchsorted(starts, [end - length + 2 for end, (length, _, _) in found])
    for a, (_, (_, n, owners)) in sorted(zip(first.tolist(), found), key=lambda x: x[0]):
        items.update(owners)
        if ranges and a <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], a + n))
        else:
            ranges.append((a, a + n))
    return ranges, items


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of word ranges."""
    spans, lowered = [], text.translate({c: c + 32 for c in range(0x41, 0x5B)})
    wanted, at = iter(ranges), None
    at = next(wanted, None)
    for k, m in enumerate(WORD.finditer(lowered)):
        if at is None:
            break
        if k == at[0]:
            begin = m.start()
        if k == at[1] - 1:
            spans.append((begin, m.end()))
            at = next(wanted, None)
    return spans


HIT_SCHEMA = "n_words long, hits array<struct<first:long,last:long>>, spans array<struct<begin:long,end:long>>, items array<string>"
_RANGE = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _scan_part(docs: DataFrame, pairs: list[tuple[str | None, bytes]], keep: list[str], text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = build_automaton(shared.value)
        for whole in batches:
            sizes = [len(t) if t is not None else 0 for t in (x.as_py() for x in whole.column(0))]
            for a, b in pieces_of(sizes, 8_000_000):
                batch = whole.slice(a, b - a)
                n, hits, spans, items = [], [], [], []
                for t in batch.column(0).to_pylist():
                    words = words_of(t)
                    ranges, owners = scan(words, machine)
                    n.append(len(words))
                    hits.append([{"first": x, "last": y} for x, y in ranges])
                    spans.append([{"begin": x, "end": y} for x, y in original_spans(t, ranges)] if ranges else [])
                    items.append(sorted(owners, key=lambda x: (x is None, x)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array(n, pa.int64()), pa.array(hits, _RANGE), pa.array(spans, _SPAN), pa.array(items, pa.list_(pa.string()))],
                    [*keep, "n_words", "hits", "spans", "items"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col(text_col).cast("string").alias("__text"), *keep).mapInArrow(run, f"{fields}, {HIT_SCHEMA}")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, keep: list[str] | None = None, text_col: str = "text",
                  max_automaton_chars: int = MAX_AUTOMATON_CHARS) -> DataFrame:
    """The ``keep`` columns (doc_id) of ``docs`` plus n_words, hits (merged word ranges), spans (character offsets) and items."""
    keep = ["doc_id"] if keep is None else keep
    wins = stored(item_windows(items, window), "windows")
    chars = wins.agg(F.sum(F.octet_length("win") + F.coalesce(F.octet_length("item_id"), F.lit(0)))).head()[0] or 0
    if chars <= max_automaton_chars:
        # the checked bound: at most max_automaton_chars bytes of windows and ids reach the driver
        return _scan_part(docs, [tuple(r) for r in wins.collect()], keep, text_col)
    return _in_parts(docs, wins, -(-2 * chars // max_automaton_chars), keep, text_col)


def _in_parts(docs: DataFrame, wins: DataFrame, parts: int, keep: list[str], text_col: str) -> DataFrame:
    """More windows than one automaton may hold: scan once per hash part, unite the marks of each row."""
    row, = fresh(docs, "row_")
    path = scratch_path(docs.sparkSession, "rows")
    docs.select(F.concat_ws("-", F.spark_partition_id(), F.monotonically_increasing_id()).alias(row), *dict.fromkeys([*keep, text_col])).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    united = None
    for k in range(parts):
        part = wins.where(F.pmod(F.xxhash64("win"), F.lit(parts)) == k)
        one = _scan_part(rows, [tuple(r) for r in part.collect()], [row], text_col)
        united = one if united is None else united.unionByName(one)
    marks = united.groupBy(row).agg(
        F.max("n_words").alias("n_words"), _merged("hits", "first", "last"), _merged("spans", "begin", "end"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return rows.select(row, *keep).join(marks, row).select(*keep, "n_words", "hits", "spans", "items")


def _merged(name: str, first: str, last: str):
    """Union of the ranges collected from the parts (one list per part and row, so at most ``parts`` lists)."""
    ranges = F.array_sort(F.flatten(F.collect_list(name)))
    kind = f"array<struct<{first}:long,{last}:long>>"

    def add(done, x):
        end = F.element_at(done, -1)
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1),
                         F.array(F.struct(end[first].alias(first), F.greatest(end[last], x[last]).alias(last))))
        return F.when(F.size(done) == 0, F.array(x)).when(x[first] <= end[last], grown).otherwise(F.concat(done, F.array(x)))

    return F.reduce(ranges, F.array().cast(kind), add).alias(name)


def digest(marked: DataFrame) -> DataFrame:
    """The contract columns from the operator's output."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"])
    return marked.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` without any hit word, with their own columns."""
    packed = docs.select("text", F.struct(*docs.columns).alias("row"))  # the caller's columns cannot clash with the marks
    return contamination(packed, items, window, keep=["row"]).where(F.size("hits") == 0).select("row.*")
