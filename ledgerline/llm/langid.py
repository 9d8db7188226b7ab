"""Language identification with interpolated Kneser-Ney character models in sorted arrays of exact grams.

Texts are lower-cased letters: every run of other characters is one boundary
symbol, and a boundary stands at either end. A model of order four per
language is estimated from the counts of all four-grams of all training
documents (counted per task, summed by Spark): the highest order from counts,
the lower orders from continuation counts, each interpolated with the next
lower one by the absolute discount D = n1 / (n1 + 2 n2), down to a uniform
share over the language's letters.

Counts are kept per language and four-gram under the exact packed 64-bit gram;
no gram is dropped or merged with another, so the models grow with the number of distinct
four-grams. (A symbol has 16 bits: letters beyond the basic plane share symbols with others.)
The bytes of the models are therefore reckoned from the counts before anything is
gathered: as many languages as stay below ``model_bytes`` are gathered, modelled
and broadcast together. If that is not all, one group of languages after another scores
all documents, which carry their best two values along; cross-entropies
of languages do not depend on each other, so the result is the same. One language
whose model alone exceeds the bound is an error that names it. A group's
values are stored side by side in one array per order, sorted by
packed gram, and a text is scored by binary search that compares whole grams:
at the highest order first, what is not there at the next lower one with the
context's back-off weight. The language with the lowest cross-entropy per
symbol wins; ties go to the first in the order of names.

Rejection is calibrated on every training row with a letter, repeated rows each time: the
cross-entropy under the own language gives a limit per language (its 99.5th
percentile plus a margin, if there are 20 rows), and a logistic function of the lead over the second
language gives the score. The training rows are scored as documents are later; their few
numbers are stored, and both come from sums over them: the percentile from counts of one
byte of the values after the other, the function from Newton steps whose sums are
decimals, so that neither depends on the order or the partitions of the rows.
Documents above the limit are marked rejected and keep their best language.

Defined cases: a null text or one without a letter is ``und`` with score 0; a
single learned language always wins; without training rows every document is
``und``; lang null is not learned from; repeated rows count each time and get
equal predictions; empty tables give empty results; other columns are never
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import drop, pieces_of, stored

ORDER = 4
BOUNDARY = 1  # symbol of everything that is not a letter; 0 is never a symbol
UNKNOWN = "und"
MODEL_BYTES = 400_000_000
QUANTILE, LEAST_ROWS = 0.995, 20  # of the own language's cross-entropies, and how many a limit takes
_CHARS = 2_000_000

_symbols: np.ndarray | None = None


def symbols() -> np.ndarray:
    """16-bit symbol by code point: lower-cased letters, else the boundary (letters beyond 16 bits are folded)."""
    global _symbols
    if _symbols is None:
        out = np.full(0x110000, BOUNDARY, np.uint16)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ord(ch.lower()[0])
                out[c] = max(2, (low ^ low >> 16) & 0xFFFF)
        _symbols = out
    return _symbols


def four_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(grams, ends): the four-grams of the texts, one after another, packed 16 bits a symbol, and their counts added up.

    A text's symbols are preceded by three boundaries and followed by one; a gram ends at each symbol after them.
    """
    joined = "\0\0\0" + "\0\0\0\0".join(texts) + "\0"  # every text: three boundaries before, one after
    code = symbols()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + 4)
    owner_end = np.zeros(len(code), bool)  # the separators' places: they are kept whatever stands next to them
    starts = ends - (lengths + 4)
    for k in range(3):
        owner_end[starts + k] = True
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != BOUNDARY) | (code[:-1] != BOUNDARY)
    keep |= owner_end
    keep[starts + 3] &= code[starts + 3] != BOUNDARY  # what follows the three boundaries directly
    kept = np.cumsum(keep)
    text_ends = kept[ends - 1]
    wide = code[keep].astype(np.uint64)
    gram = wide.copy()
    for k in range(1, ORDER):
        gram[k:] |= wide[:-k] << np.uint64(16 * k)
    inside = np.ones(len(wide), bool)
    begin = np.concatenate(([0], text_ends[:-1]))
    for k in range(3):
        inside[np.minimum(begin + k, len(wide) - 1)] = False
    counts = np.diff(np.concatenate(([0], text_ends))) - 3
    return gram[inside], np.cumsum(counts)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): the count of every four-gram, packed, of all rows with a text and a lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def sums(lang):
            grams, counts = (np.concatenate(x) for x in zip(*held.pop(lang)))
            unique, inverse = np.unique(grams, return_inverse=True)
            return unique, np.bincount(inverse, weights=counts).astype(np.int64)

        def batch(lang, grams, counts):
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64), pa.int64()),
                 pa.array(counts, pa.int64())], ["lang", "gram", "n"])

        for whole in batches:
            texts, langs = whole.column(0).to_pylist(), np.array(whole.column(1).to_pylist(), object)
            for lang in sorted(set(langs.tolist())):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for a, b in pieces_of([len(t) for t in own], _CHARS):
                    grams, counts = np.unique(four_grams(own[a:b])[0], return_counts=True)
                    held.setdefault(lang, []).append((grams, counts))
                    if sum(len(x) for x, _ in held[lang]) > 3_000_000:  # keep what is held small
                        both = sums(lang)
                        held[lang] = [both]
                        if len(both[0]) > 1_500_000:
                            yield batch(lang, *held.pop(lang)[0])
        for lang in sorted(held):
            yield batch(lang, *sums(lang))

    rows = docs.where("text is not null and lang is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    each = rows.mapInArrow(run, "lang string, gram long, n long")
    return each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Tables:
    """Values by order, for all languages side by side; keys are sorted packed grams."""
    langs: list[str]
    keys: list[np.ndarray]  # per order, the highest first
    values: list[np.ndarray]  # log2 probabilities, one column per language
    contexts: list[np.ndarray]  # packed contexts of the highest orders, sorted
    weights: list[np.ndarray]  # log2 back-off weights, one column per language
    unseen: np.ndarray  # log2 probability of a symbol no language has
    limit: np.ndarray | None = None  # highest accepted cross-entropy by language
    lead: np.ndarray | None = None  # logistic function of the lead

    def tables(self) -> Iterator[tuple[int, Tables]]:
        """The one group."""
        yield 0, self


def _discount(counts: np.ndarray) -> float:
    n1, n2 = int((counts == 1).sum()), int((counts == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


def estimate(grams: np.ndarray, counts: np.ndarray) -> tuple[list[tuple], list[tuple], float]:
    """One language: per order (grams, log2 p), per order (contexts, log2 weight), and log2 p of an unseen symbol."""
    levels = [(grams, counts)]
    for k in range(1, ORDER):  # continuation counts: distinct longer grams by their last symbols
        mask = np.uint64((1 << 16 * (ORDER - k)) - 1)
        levels.append(np.unique(levels[-1][0] & mask, return_counts=True))
    top_grams, top_counts = levels[-1]
    alphabet = len(top_grams) + 1
    lower_p, out_p, out_w = None, [], []
    unseen = 0.0
    for k in range(ORDER - 1, -1, -1):
        g, c = levels[k]
        d = _discount(c)
        # the context's symbols are the gram without its last one
        context = g >> np.uint64(16) if k < ORDER - 1 else np.zeros(len(g), np.uint64)
        names, place = np.unique(context, return_inverse=True)
        total = np.bincount(place, weights=c)
        weight = d * np.bincount(place) / total
        if lower_p is None:
            base = np.full(len(g), 1 / alphabet)
            unseen = float(weight[0] / alphabet)
        else:
            suffix = g & np.uint64((1 << 16 * (ORDER - k - 1)) - 1)
            base = lower_p[1][np.searchsorted(lower_p[0], suffix)]
        p = np.maximum(c - d, 0) / total[place] + weight[place] * base
        lower_p = (g, p)
        out_p.insert(0, (g, np.log2(p)))
        out_w.insert(0, (names, np.log2(weight)))
    return out_p, out_w[:-1], float(np.log2(unseen))


def build(per_lang: dict[str, tuple[np.ndarray, np.ndarray]]) -> Tables:
    langs = sorted(per_lang)
    found = {}
    for lang in langs:
        grams, counts = per_lang[lang]
        order = np.argsort(grams)
        found[lang] = estimate(grams[order], counts[order])
    unseen = np.array([found[x][2] for x in langs])
    tables = Tables(langs, [], [], [], [], unseen)
    for k in range(ORDER - 1, -1, -1):  # lowest order first, so that gaps are filled from below
        keys = np.unique(np.concatenate([found[x][0][k][0] for x in langs]))
        if k < ORDER - 1:
            names = np.unique(np.concatenate([found[x][1][k][0] for x in langs]))
            w = np.zeros((len(names), len(langs)))
            for j, x in enumerate(langs):
                w[np.searchsorted(names, found[x][1][k][0]), j] = found[x][1][k][1]
            below = _at(tables, 0, keys & np.uint64((1 << 16 * (ORDER - k - 1)) - 1)) + _rows(names, w, keys >> np.uint64(16))
            tables.contexts.insert(0, names)
            tables.weights.insert(0, w)
        else:
            below = np.broadcast_to(unseen, (len(keys), len(langs))).copy()
        for j, x in enumerate(langs):
            own, p = found[x][0][k]
            below[np.searchsorted(keys, own), j] = p
        tables.keys.insert(0, keys)
        tables.values.insert(0, below)
    return tables


def _rows(names: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rows of ``values`` by sorted key; zeros for keys that are not there."""
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return np.where((names[at] == wanted)[:, None], values[at], 0.0)


def _at(t: Tables, level: int, grams: np.ndarray) -> np.ndarray:
    """log2 p by language of packed grams, from ``level`` (in the lists as they are) down to single symbols."""
    keys, values = t.keys[level], t.values[level]
    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    out = values[at]
    missing = np.flatnonzero(keys[at] != grams)
    if len(missing):
        rest = grams[missing]
        if level + 1 == len(t.keys):
            out[missing] = t.unseen
        else:
            size = len(t.keys) - level
            out[missing] = _at(t, level + 1, rest & np.uint64((1 << 16 * (size - 1)) - 1)) + _rows(t.contexts[level], t.weights[level], rest >> np.uint64(16))
    return out


def entropies(texts: list[str], t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(cross-entropy per symbol by text and language, number of letters by text)."""
    grams, ends = four_grams(texts)
    logs = _at(t, 0, grams)
    starts = np.concatenate(([0], ends[:-1]))
    letters = np.concatenate(([0], np.cumsum((grams & np.uint64(0xFFFF)) != BOUNDARY)))
    n = ends - starts
    sums = np.zeros((len(texts), len(t.langs)))
    if len(logs):
        sums[n > 0] = np.add.reduceat(logs, starts[n > 0], axis=0)  # texts without a gram would cut the one before them
    h = np.where(n[:, None] > 0, -sums / np.maximum(n, 1)[:, None], 0.0)
    return h, letters[ends] - letters[starts]


def leaders(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the lowest value, the lowest, the second lowest or infinity) of every row."""
    n, rows = h.shape[1], np.arange(len(h))
    if not n:
        return np.zeros(len(h), int), np.zeros(len(h)), np.full(len(h), np.inf)
    best = np.argmin(h, axis=1)
    second = np.partition(h, 1, axis=1)[:, 1] if n > 1 else np.full(len(h), np.inf)
    return best, h[rows, best], second


def strength(low: np.ndarray, second: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The lead over the second language, greater for longer texts."""
    gap = np.where(np.isinf(second), 1.0, second - low)
    return gap * np.sqrt(np.minimum(letters, 400)) / 4


def verdict(best: np.ndarray, low: np.ndarray, second: np.ndarray, letters: np.ndarray, limit, lead) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the best language or -1, score, rejected)."""
    a, b = lead if lead is not None else (0.0, 10.0)
    score = 1 / (1 + np.exp(-np.clip(a + b * strength(low, second, letters), -30, 30)))
    rejected = low > limit[best] if limit is not None else np.zeros(len(best), bool)
    none = letters == 0
    return np.where(none, -1, best), np.where(none, 0.0, score), rejected & ~none


def decide(h: np.ndarray, letters: np.ndarray, t) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The verdict over cross-entropies by text and language; ``t`` has the limits and the lead's function."""
    return verdict(*leaders(h), letters, t.limit, t.lead)


def sortable(values: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles."""
    bits = (values + 0.0).view(np.int64)  # no negative zero
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def unsorted(keys: np.ndarray) -> np.ndarray:
    """The doubles of ``sortable`` integers (the same exchange)."""
    return np.where(keys < 0, keys ^ np.int64(0x7FFFFFFFFFFFFFFF), keys).view(np.float64)


def quantiles(rows: DataFrame, n: int, q: float = QUANTILE, least: int = LEAST_ROWS) -> np.ndarray:
    """The ``q`` quantile of the values ``key`` (sortable) of each ``y`` below ``n``, as numpy interpolates it; infinity for fewer rows.

    Both values beside the quantile are found byte by byte: each pass counts the rows by the next byte among
    those that share a value's bytes so far, at most 512 counts a language.
    """
    prefix: list[list[int | None]] = [[0] * n, [0] * n]  # of the lower and the upper value; none: no limit
    rest = [[0] * n, [0] * n]  # its rank among the rows with this prefix
    part = np.zeros(n)
    for shift in range(56, -1, -8):
        chosen = rows
        if shift < 56:
            before = F.shiftright("key", shift + 8)
            low, high = (F.element_at(F.array(*[F.lit(v).cast("long") for v in p]), F.col("y") + 1) for p in prefix)
            chosen = rows.where((before == low) | (before == high))
        counts: dict[int, list[tuple[int, int]]] = {}
        for r in chosen.groupBy("y", F.shiftright("key", shift).alias("b")).count().collect():
            counts.setdefault(r["y"], []).append((r["b"], r["count"]))
        for j in range(n):
            own = sorted(counts.get(j, []))
            if shift == 56:
                total = sum(c for _, c in own)
                at = q * (total - 1)
                part[j] = at - int(at)
                enough = total >= least
                rest[0][j], rest[1][j] = int(at), min(int(at) + 1, total - 1)
                prefix[0][j] = prefix[1][j] = 0 if enough else None
            for p, k in zip(prefix, rest):
                if p[j] is None:
                    continue
                for b, c in own:
                    if shift < 56 and b >> 8 != p[j]:
                        continue
                    if k[j] < c:
                        p[j] = b
                        break
                    k[j] -= c
    out = np.full(n, np.inf)
    for j in range(n):
        if prefix[0][j] is not None:
            out[j] = np.quantile(unsorted(np.array([prefix[0][j], prefix[1][j]], np.int64)), part[j])
    return out


def lead_function(rows: DataFrame, steps: int = 30) -> np.ndarray:
    """(a, b) of the logistic regression of ``right`` on ``x``, with a prior that keeps a rising function when every row is right."""
    w = np.array([0.0, 1.0])
    x = F.col("x")
    for _ in range(steps):
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(F.lit(float(w[0])) + x * float(w[1]), F.lit(30.0)), F.lit(-30.0))))
        at = rows.select("x", (F.col("right") - p).alias("d"), (p * (F.lit(1.0) - p)).alias("v"))
        terms = [F.col("d"), F.col("d") * x, F.col("v"), F.col("v") * x, F.col("v") * x * x]
        d0, d1, v0, v1, v2 = (float(c or 0) for c in at.agg(*[F.sum(c.cast("decimal(38,18)")) for c in terms]).head())
        g = np.array([d0, d1]) - (w - [0.0, 1.0])
        step = np.clip(np.linalg.solve(np.array([[v0, v1], [v1, v2]]) + np.eye(2), g), -2, 2)
        w = w + step
        if np.abs(step).max() < 1e-12:
            break
    return np.array([w[0], max(w[1], 0.01)])


def calibrated(known: DataFrame, model: Tables | Grouped, margin: float = 0.25) -> tuple[np.ndarray, np.ndarray]:
    """(limits, the lead's logistic function) from every row of ``known`` (text, lang) with a letter."""
    langs = model.langs
    rows = known.select(F.col("text").cast("string").alias("text"),
                        (F.array_position(F.array(*map(F.lit, langs)), F.col("lang").cast("string")) - 1).cast("int").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            y, best, low, second, letters, own = (part.column(c).to_numpy() for c in ("y", "best", "low", "second", "letters", "own"))
            some = letters > 0
            x = np.minimum(strength(low[some], second[some], letters[some]), 30.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(y[some]), pa.array(sortable(own[some])), pa.array(x), pa.array((best == y)[some].astype(np.int32))],
                ["y", "key", "x", "right"])

    scored = _passes(rows, model, []).mapInArrow(run, "y int, key long, x double, right int")
    numbers = stored(scored, "calibration")
    return quantiles(numbers, len(langs)) + margin, lead_function(numbers)


@dataclass
class Grouped:
    """Models that do not fit together: languages in groups, built one group at a time from the stored counts."""
    langs: list[str]
    groups: list[list[str]]
    counts: DataFrame
    limit: np.ndarray | None = None
    lead: np.ndarray | None = None

    def tables(self) -> Iterator[tuple[int, Tables]]:
        """(index of the first language, models) group by group."""
        first = 0
        for group in self.groups:
            yield first, build(_gathered(self.counts, group))
            first += len(group)


def _gathered(counts: DataFrame, langs: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Grams and counts by language: 16 bytes a distinct gram."""
    out = {}
    for x in langs:
        arrow = counts.where(F.col("lang") == x).select("gram", "n").toArrow()
        out[x] = arrow.column("gram").to_numpy().view(np.uint64), arrow.column("n").to_numpy()
    return out


def grouped(sizes: dict[str, int], model_bytes: int) -> list[list[str]]:
    """Languages in order, in groups whose models stay below ``model_bytes``; ``sizes`` are distinct four-grams.

    All orders together have at most twice as many grams; each has a key and a value for every language
    of its group, and as much again may be held while the arrays are made.
    """
    cost = lambda grams, langs: 2 * 2 * grams * 8 * (1 + langs)
    out: list[list[str]] = []
    total = 0
    for x in sorted(sizes):
        if cost(sizes[x], 1) > model_bytes:
            raise ValueError(f"the model of {x} ({sizes[x]} four-grams) exceeds model_bytes = {model_bytes}")
        if not out or cost(total + sizes[x], len(out[-1]) + 1) > model_bytes:
            out.append([])
            total = 0
        out[-1].append(x)
        total += sizes[x]
    return out


def fit(docs: DataFrame, model_bytes: int = MODEL_BYTES) -> Tables | Grouped | None:
    """Learn from every row of ``docs`` (text, lang) that has a text and a lang."""
    known = docs.where("text is not null and lang is not null")
    counts = stored(gram_counts(known), "grams")
    sizes = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return None
    langs = sorted(sizes)
    model = Grouped(langs, grouped(sizes, model_bytes), counts)
    if len(model.groups) == 1:
        model = build(_gathered(counts, langs))
    model.limit, model.lead = calibrated(known, model)
    return model


_RESULT = "lang_pred string, score double, cross_entropy double, rejected boolean"


def _named(langs: list[str], best: np.ndarray, score: np.ndarray, low: np.ndarray, rejected: np.ndarray) -> list[pa.Array]:
    names = [langs[i] if i >= 0 else UNKNOWN for i in best.tolist()]
    return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(low, pa.float64(), mask=best < 0), pa.array(rejected, pa.bool_())]


def _passes(rows: DataFrame, model: Tables | Grouped, kept: list[str]) -> DataFrame:
    """The ``kept`` columns and y of ``rows`` (text, y, kept) with best, low, second and letters, and own: the cross-entropy under language y.

    One stored pass for each group; the values so far travel with the row, the text as long as a pass follows.
    A pass is dropped when the next one is stored.
    """
    spark, last = rows.sparkSession, len(model.langs)
    state = ["best", "low", "second", "letters", "own"]
    kept = ["y", *kept]
    fields = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in kept) + "best int, low double, second double, letters long, own double"
    none = F.lit(float("inf"))
    rows = rows.select("text", *kept, F.lit(-1).alias("best"), none.alias("low"), none.alias("second"), F.lit(0).cast("long").alias("letters"), none.alias("own"))

    def scored(rows: DataFrame, first: int, t: Tables) -> DataFrame:
        shared, end = spark.sparkContext.broadcast(t), first + len(t.langs)
        texts_on = ["text"] if end < last else []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                texts = [s or "" for s in whole.column("text").to_pylist()]
                for a, b in pieces_of([len(s) for s in texts], _CHARS):
                    part = whole.slice(a, b - a)
                    y, best, low, second, own = (part.column(c).to_numpy() for c in ("y", "best", "low", "second", "own"))
                    h, letters = entropies(texts[a:b], shared.value)
                    at, at_low, at_second = leaders(h)
                    better = at_low < low  # ties stay with the group before
                    second = np.where(better, np.minimum(low, at_second), np.minimum(second, at_low))
                    mine = (y >= first) & (y < end)
                    own = np.where(mine, h[np.arange(b - a), np.where(mine, y - first, 0)], own)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in (*texts_on, *kept)), pa.array(np.where(better, at + first, best), pa.int32()),
                         pa.array(np.where(better, at_low, low)), pa.array(second), pa.array(letters, pa.int64()), pa.array(own)],
                        [*texts_on, *kept, *state])

        out = stored(rows.mapInArrow(run, "text string, " * len(texts_on) + fields), "scored")
        shared.destroy()
        return out

    before: list[str] = []
    for first, t in model.tables():
        rows = scored(rows, first, t)
        for path in before:
            drop(spark, path)
        before = [f.rsplit("/", 1)[0] for f in rows.inputFiles()[:1]]
    return rows


def _predict_grouped(docs: DataFrame, model: Grouped, keep: list[str], text_col: str) -> DataFrame:
    """One stored pass over the documents for each group of languages."""
    kept = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.lit(-1).alias("y"), *[F.col(c).alias(n) for c, n in zip(keep, kept)])
    rows = _passes(rows, model, kept)
    langs, limit, lead = model.langs, model.limit, model.lead

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            best, low, second, letters = (part.column(c).to_numpy() for c in ("best", "low", "second", "letters"))
            best, score, rejected = verdict(best, low, second, letters, limit, lead)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *_named(langs, best, score, low, rejected)],
                                             [*keep, "lang_pred", "score", "cross_entropy", "rejected"])

    named = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(run, f"{named}{_RESULT}")


def predict(docs: DataFrame, t: Tables | Grouped | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns plus lang_pred, score, cross_entropy and rejected, for every row."""
    if isinstance(t, Grouped):
        return _predict_grouped(docs, t, keep, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(t)  # below model_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for whole in batches:
            texts = [s or "" for s in whole.column(0).to_pylist()]
            for a, b in pieces_of([len(s) for s in texts], _CHARS):
                if t is None:
                    best, score, low, rejected = np.full(b - a, -1), np.zeros(b - a), np.zeros(b - a), np.zeros(b - a, bool)
                else:
                    h, letters = entropies(texts[a:b], t)
                    best, score, rejected = decide(h, letters, t)
                    low = h[np.arange(b - a), np.maximum(best, 0)]
                yield pa.RecordBatch.from_arrays([*whole.slice(a, b - a).columns[1:], *_named(t.langs if t else [], best, score, low, rejected)],
                                                 [*keep, "lang_pred", "score", "cross_entropy", "rejected"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col(text_col).cast("string").alias("__text"), *keep).mapInArrow(run, f"{fields}, {_RESULT}")
