"""Periodic run detection: maximal stretches of words that repeat with a period at least four times over.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and length >= max(6, 4 q) that no neighbouring word extends
keeping period q. Words are the maximal matches of ``[^\\x20\\x09-\\x0D]+``.

Method. The words of a batch of documents become integers and are laid end to
end, each document closed by an integer of its own, so no run crosses a border.

* Periods up to ``SHORT`` are found by direct scans: stretches of positions
  whose word equals the one q places on.
* Periods in (P, 2 P], for P = SHORT, 2 SHORT, 4 SHORT, ..., are found by the
  minimizers of that scale: the smallest hash of a gram of 2 P words in each
  window of P positions. Inside a run the window contents repeat after q
  words, so the minimum of the run's first window is also that of the window q
  further on; a gram as long as the period occurs in a run only at multiples
  of q, so the two are neighbours among the equal minimizers. Each pair of
  neighbouring equal minimizers with a distance in (P, 2 P] is a seed, extended
  word by word to both sides as far as the period holds. A pair inside a
  stretch that the same period already gave is not extended again.

A stretch with period q is dropped if a proper divisor of q is a period too
(by the theorem of Fine and Wilf no other smaller period is possible at this
length). Grams are compared by 64-bit hashes, words by identity: a collision
could only hide one of several seeds of a run, and no false run can arise.

Work is linear in the words of a document at each scale; memory is that of one
batch of texts, at least one whole document. There is no shuffle.

Defined cases: null and empty texts have no words, no runs and an empty
collapsed text; repeated rows give equal results; empty tables give empty
results; other columns are only carried where the caller names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACES, fresh, pieces_of

SHORT = 8  # longest period of the direct scans, and window of the first scale
LEAST, TIMES = 6, 4  # a run has at least LEAST words and TIMES periods
BATCH_BYTES = 4_000_000


def hashes(ids: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each integer."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _paired(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of grams of 2 k words from those of k words."""
    x = h[:-k] * np.uint64(0x94D049BB133111EB) + h[k:]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def minimizers(h: np.ndarray, window: int) -> np.ndarray:
    """Positions of the leftmost smallest hash of every window (a power of two of positions), each once, ascending."""
    if len(h) < window:
        return np.zeros(0, np.int64)
    at, size = np.arange(len(h), dtype=np.int64), 1
    while size < window:
        a, b = at[:-size], at[size:]
        at = np.where(h[a] <= h[b], a, b)
        size *= 2
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def _divisors(q: int) -> list[int]:
    """The largest proper divisors q / r, one for each prime factor r."""
    out, rest, r = [], q, 2
    while r * r <= rest:
        if rest % r == 0:
            out.append(q // r)
            while rest % r == 0:
                rest //= r
        r += 1
    if rest > 1:
        out.append(q // rest)
    return out


def _smallest(ids: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch of period q (at least 2 q long) has no smaller period that divides q."""
    block = ids[start:start + q]
    return not any(np.array_equal(block, ids[start + d:start + d + q]) for d in _divisors(q))


def _reach(ids: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The largest [a, b) around ``at`` with ids[i] == ids[i + q] throughout; compares blocks of growing size."""
    a, size = at, 64
    while a > 0:
        low = max(0, a - size)
        bad = np.flatnonzero(ids[low:a] != ids[low + q:a + q])
        if len(bad):
            a = low + int(bad[-1]) + 1
            break
        a, size = low, size * 2
    b, size, end = at, 64, len(ids) - q
    while b < end:
        high = min(end, b + size)
        bad = np.flatnonzero(ids[b:high] != ids[b + q:high + q])
        if len(bad):
            b += int(bad[0])
            break
        b, size = high, size * 2
    return a, b


class _Laid:
    """Some of the documents end to end, each closed by an integer that occurs once."""

    def __init__(self, ids: np.ndarray, begins: np.ndarray, sizes: np.ndarray, docs: np.ndarray):
        self.docs = docs
        n = sizes[docs]
        self.borders = np.cumsum(n) + np.arange(len(docs))
        self.begins = self.borders - n
        self.ids = np.empty(int(n.sum()) + len(docs), np.int64)
        place = np.arange(len(self.ids), dtype=np.int64)
        inside = np.ones(len(self.ids), bool)
        inside[self.borders] = False
        shift = np.repeat(begins[docs] - self.begins, n)
        self.ids[inside] = ids[place[inside] + shift]
        self.ids[self.borders] = (int(ids.max()) if len(ids) else 0) + 1 + np.arange(len(docs))
        self.h, self.k = hashes(self.ids), 1

    def grams(self, k: int) -> np.ndarray:
        """Hashes of the grams of ``k`` words (a power of two, not less than asked for before)."""
        while self.k < k and len(self.h) > self.k:
            self.h = _paired(self.h, self.k)
            self.k *= 2
        return self.h if self.k == k else self.h[:0]

    def named(self, start: int, length: int, q: int) -> tuple[int, int, int, int]:
        """(document, first word, length, period) of a stretch."""
        d = int(np.searchsorted(self.borders, start, side="left"))
        return int(self.docs[d]), start - int(self.begins[d]), length, q


def _scan(laid: _Laid, q: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs of period ``q`` by comparing every word with the one ``q`` places on."""
    ids = laid.ids
    differ = np.flatnonzero(ids[:-q] != ids[q:])
    stops = np.concatenate((differ, [len(ids) - q]))
    starts = np.concatenate(([0], differ + 1))
    for i in np.flatnonzero(stops - starts + q >= max(LEAST, TIMES * q)).tolist():
        a = int(starts[i])
        if _smallest(ids, a, q):
            yield laid.named(a, int(stops[i]) - a + q, q)


def _seeded(laid: _Laid, scale: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs with periods in (scale, 2 scale] from neighbouring equal minimizers."""
    ids, h = laid.ids, laid.grams(2 * scale)
    at = minimizers(h, scale)
    order = at[np.argsort(h[at], kind="stable")]
    gap = np.diff(order)
    good = (h[order[1:]] == h[order[:-1]]) & (gap > scale) & (gap <= 2 * scale)
    seeds, periods = order[:-1][good], gap[good]
    by = np.lexsort((seeds, periods))
    last, done = 0, 0  # the period before, and up to where its stretch is known
    for m, q in zip(seeds[by].tolist(), periods[by].tolist()):
        if q == last and m < done:
            continue
        a, b = _reach(ids, m, q)
        last, done = q, max(b, m + 1)
        if b - a + q >= max(LEAST, TIMES * q) and _smallest(ids, a, q):
            yield laid.named(a, b - a + q, q)


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of documents laid end to end, as rows (document, start, length, period) in this order of columns.

    ``ids`` are the words as integers from 0, ``sizes`` the word counts of the documents.
    """
    found: list[tuple[int, int, int, int]] = []
    begins = np.cumsum(sizes) - sizes
    docs = np.flatnonzero(sizes >= LEAST)
    if len(docs):
        laid = _Laid(ids, begins, sizes, docs)
        for q in range(1, SHORT + 1):
            found += _scan(laid, q)
        scale = SHORT
        while len(docs := np.flatnonzero(sizes >= TIMES * (scale + 1))):  # documents that can hold such a period
            if 2 * len(docs) < len(laid.docs):
                laid = _Laid(ids, begins, sizes, docs)
            found += _seeded(laid, scale)
            scale *= 2
    out = np.array(sorted((d, a, q, n) for d, a, n, q in found), np.int64).reshape(-1, 4)
    return out[:, [0, 1, 3, 2]]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words end to end, words of each text) of a string array; nulls have none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, parent = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.not_equal(pc.binary_length(words), 0)
    return words.filter(some), np.bincount(parent.filter(some).to_numpy(), minlength=len(texts)).astype(np.int64)


def _runs_of(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(runs, collapsed text, number of words) of each text."""
    words, sizes = split_words(texts)
    ids = pc.dictionary_encode(words).indices.to_numpy().astype(np.int64) if len(words) else np.zeros(0, np.int64)
    runs = find_runs(ids, sizes)
    begins = np.cumsum(sizes) - sizes
    change = np.zeros(len(words) + 1, np.int64)  # covered words, after each run's first period
    first = begins[runs[:, 0]] + runs[:, 1]
    np.add.at(change, first + runs[:, 3], 1)
    np.add.at(change, first + runs[:, 2], -1)
    kept = np.cumsum(change[:-1]) == 0
    left = np.concatenate(([0], np.cumsum(kept)))[np.concatenate((begins, [len(words)]))]
    offsets = pa.array(left, pa.int32())
    collapsed = pc.binary_join(pa.ListArray.from_arrays(offsets, words.filter(pa.array(kept))), " ")
    each = np.concatenate(([0], np.cumsum(np.bincount(runs[:, 0], minlength=len(texts)))))
    listed = pa.ListArray.from_arrays(pa.array(each, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"]))
    return listed, collapsed, pa.array(sizes)


SCHEMA = "runs array<struct<start:long,length:long,period:long>>, collapsed string, n_words long"


def periodic_runs(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of ``docs`` plus runs (by start, then period), collapsed text and n_words, for every row.

    The collapsed text holds the words that no run covers after its first period, joined by one space.
    """
    text, = fresh(docs.select(*keep), "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(0)), 0).to_pylist()
            for a, b in pieces_of(sizes, BATCH_BYTES):
                part = whole.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *_runs_of(part.column(0))], [*keep, "runs", "collapsed", "n_words"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col(text_col).cast("string").alias(text), *keep).mapInArrow(run, f"{fields}, {SCHEMA}" if keep else SCHEMA)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with periodic tails in the texts whose id asks for one.

    With h the crc32 of the id in decimal and g = h div 10: if h mod 10 is 0 and the text has n > 0 words, each
    word i >= a becomes word a + (i - a) mod p of the text, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    Other texts, and rows without an id, stay as they are.
    """
    words, hashed = fresh(docs, "__words", "__h")
    chosen = docs.withColumn(hashed, F.crc32(F.col(id_col).cast("string").cast("binary")))
    split = F.filter(F.split(text_col, f"{SPACES}+"), lambda w: w != "")
    chosen = chosen.withColumn(words, F.when(F.col(hashed) % 10 == 0, split))

    def tail(w: Column, n: Column, g: Column) -> Column:
        a = F.call_function("mod", g, n)
        p = 1 + F.call_function("div", n - a, 3 + g % 8)
        place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.call_function("mod", i - a, F.greatest(p, F.lit(1)))))
        return F.transform(place, lambda i: w[i.cast("int")])

    w = F.col(words)
    g = F.call_function("div", F.col(hashed), F.lit(10))
    rewritten = F.array_join(tail(w, F.size(w).cast("long"), g), " ")
    return chosen.withColumn(text_col, F.when(w.isNotNull() & (F.size(w) > 0), rewritten).otherwise(F.col(text_col))).drop(words, hashed)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_runs, the longest run, digests of all runs and of the collapsed text) of ``periodic_runs`` rows."""
    runs = F.col("runs")
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    start, period = -best["start"], -best["period"]
    return found.select(
        id_col, F.size(runs).cast("long").alias("n_runs"), start.alias("start"), best["length"].alias("length"), period.alias("period"),
        F.call_function("div", F.lit(1000).cast("long") * best["length"], period).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
