"""Toxicity: a linear-chain conditional random field tags toxic spans; its marginals give document scores.

Tokens are runs of letters. Labels exist per document only, so training
tokens are labelled first: a word or word beginning that occurs in a few toxic
documents (see ``least``; near copies count once) and, at equal class sizes,
with odds of at least 9 to 1 in toxic ones is evidence, and a token of a toxic
document that carries evidence gets label 1; every other token gets label 0.
The counts are made by Spark over at most about ``evidence_rows`` labelled
training rows of each class, those with the smallest keyed hash of their id: the ids are
chosen first and broadcast to the scan, so no other text moves. The field has two states; a token's
features are its word, its beginnings of 3 to 8 letters and its last 3
letters, hashed into 2^20 weights, plus start and transition scores. It is
trained by gradient steps on the exact log-likelihood (forward-backward).

A document is scored with the forward-backward marginals of all its tokens:
their sum, its density and the number of tagged tokens enter a logistic function fitted to the
document labels at their natural share. Runs of tokens with marginals of at
least one half are the toxic spans, as character offsets of the text.

The weights are fitted to a sample: at most ``per_class`` labelled documents of
each class, those with the smallest keyed hash of their id, and for evidence
that none of them holds the toxic document with the smallest hash that does, at
most ``extra`` of these
(copies and near copies in it count once). In the order of their hashes, the
texts of the sample are taken up to ``sample_bytes``; a text of more than a
sixteenth of that is not sampled. These are bounds on rows that fit the classifier; a
word that is rarer among toxic documents than one in a few thousand may not be
learned. Only ids with crc32(id as text) mod 5 other than 0
are ever used. The model is 2^20 + 10 numbers whatever the data. Scoring covers
every document in full.

Forward and backward recursions of a whole batch of documents run at once: a
two-state recursion is a fractional-linear map of the ratio of the states'
values, maps compose by 2 x 2 products, and the first token of a document is a
constant map, so documents are laid end to end and cut into equal blocks.

Defined cases: null and empty texts, or texts without letters, are scored as
documents without tokens; a document with several label rows is toxic if one
of them is; null labels, texts and ids are not learned from; without toxic (or
without clean) training rows every score is the share of toxic ones (0 if
there are no labels); repeated rows get equal scores; empty tables give empty
results; other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_remainder, pieces_of, stored

TOKEN = re.compile(r"[^\W\d_]+")
HASH_BITS, BEGINNINGS, SLOTS = 20, range(3, 9), 8  # slots: word, ending, beginnings
PER_CLASS, ROUNDS, RATE, RIDGE = 1200, 40, 0.5, 1e-4
EVIDENCE_ROWS, EXTRA, SAMPLE_BYTES = 20_000, 1200, 32_000_000
BLOCK = 128
HELD_OUT_MOD = 5


@dataclass
class Model:
    weights: np.ndarray
    start: np.ndarray  # score of beginning in state 1
    step: np.ndarray  # 2 x 2 transition scores
    doc: np.ndarray  # intercept and coefficients of the document function
    share: float  # natural share of toxic documents
    usable: bool = True
    fields: dict = field(default_factory=dict)


def features(token: str) -> list[int]:
    """Hashed features of a token: the word, its beginnings and its ending."""
    word = token.lower()
    out = [zlib.crc32(b"w" + word.encode("utf-8", "replace")), zlib.crc32(b"e" + word[-3:].encode("utf-8", "replace"))]
    out += [zlib.crc32(b"b" + word[:k].encode("utf-8", "replace")) for k in BEGINNINGS if k <= len(word)]
    mask = (1 << HASH_BITS) - 1
    return [1 + (h & mask) for h in out]  # slot 0 stays empty


def _chain(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x_t = (a x + b) / (c x + d) with x = x_{t-1}, for all t; the first map must be constant (a = c = 0)."""
    n = len(a)
    k = max(1, -(-n // BLOCK))
    pad = k * BLOCK - n
    one, zero = np.ones(pad), np.zeros(pad)
    a, b, c, d = (np.ascontiguousarray(np.concatenate((x, y)).reshape(k, BLOCK).T) for x, y in ((a, one), (b, zero), (c, zero), (d, one)))
    pa_, pb, pc, pd = np.ones(k), np.zeros(k), np.zeros(k), np.ones(k)
    for t in range(BLOCK):  # products of the maps of each block
        pa_, pb, pc, pd = a[t] * pa_ + b[t] * pc, a[t] * pb + b[t] * pd, c[t] * pa_ + d[t] * pc, c[t] * pb + d[t] * pd
        norm = 1.0 / np.maximum(pa_ + pb, pc + pd)
        pa_, pb, pc, pd = pa_ * norm, pb * norm, pc * norm, pd * norm
    enter, x = np.empty(k), 1.0
    for i, (u, v, w, z) in enumerate(zip(pa_.tolist(), pb.tolist(), pc.tolist(), pd.tolist())):
        enter[i] = x
        x = (u * x + v) / (w * x + z)
    out, x = np.empty((BLOCK, k)), enter
    for t in range(BLOCK):
        x = (a[t] * x + b[t]) / (c[t] * x + d[t])
        out[t] = x
    return out.T.ravel()[:n]


def marginals(scores: np.ndarray, first: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, r, b) of documents laid end to end: marginal of state 1, forward and backward ratios.

    ``first`` marks the first token of each document.
    """
    e = np.exp(np.clip(scores, -30, 30))
    t = np.exp(model.step)
    begin = float(np.exp(model.start[0]))
    r = _chain(np.where(first, 0, t[1, 1] * e), np.where(first, begin * e, t[0, 1] * e),
               np.where(first, 0, t[1, 0]), np.where(first, 1, t[0, 0]))
    last = np.concatenate((first[1:], [True]))[::-1]
    after = np.concatenate((e[1:], [1.0]))[::-1]
    b = _chain(np.where(last, 0, t[1, 1] * after), np.where(last, 1, t[1, 0]),
               np.where(last, 0, t[0, 1] * after), np.where(last, 1, t[0, 0]))[::-1]
    both = r * b
    return both / (1 + both), r, b


def doc_features(p: np.ndarray, scores: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per document (1, log(1 + sum), log density, offending tokens) from the marginals; ends: token counts added up.

    A token with the score of the one before it (the same token, or one that says nothing) is not counted again.
    """
    starts = np.concatenate(([0], ends[:-1]))
    n = ends - starts
    if len(p):
        again = np.concatenate(([False], scores[1:] == scores[:-1]))
        again[starts[n > 0]] = False
        p = np.where(again, 0.0, p)
    total = np.concatenate(([0.0], np.cumsum(p)))
    s = np.maximum(total[ends] - total[starts], 0)
    marked = np.concatenate(([0], np.cumsum(p >= 0.5)))
    hits = np.log1p(marked[ends] - marked[starts])
    return np.stack((np.ones(len(ends)), np.log1p(s), np.log((s + 0.5) / (n + 50)), hits), axis=1)


def _sketch(tokens: list[str]) -> tuple[int, int]:
    """Two minima over 5-word shingles; near copies share one of them."""
    grams = [" ".join(tokens[i:i + 5]).encode("utf-8", "replace") for i in range(max(1, len(tokens) - 4))]
    return min(zlib.crc32(g) for g in grams), min(zlib.crc32(g, 77) for g in grams)


def least(n1: int, n0: int) -> int:
    """Toxic documents that evidence must occur in: five, more if chance alone would put so many in a class of this share.

    At most 1.5% of the toxic ones (but five); the number does not grow with the rows.
    """
    chance = int(np.ceil(np.log(1e-3) / np.log(n1 / (n1 + n0))))
    return max(min(5, n1), min(chance, int(np.ceil(0.015 * n1))))


def train(rows: list[tuple[str, int]], share: float, strong: np.ndarray) -> Model:
    """Fit the field and the document function to (text, toxic) rows.

    ``share`` is the natural share of toxic; ``strong`` marks the features that are evidence.
    """
    empty = Model(np.zeros(1 + (1 << HASH_BITS)), np.zeros(1), np.zeros((2, 2)), np.zeros(4), share, usable=False)
    vocabulary: dict[str, int] = {}
    chains, labels, seen = [], [], set()
    for text, label in rows:
        tokens = TOKEN.findall(text)
        marks = {(label, *m) for m in enumerate(_sketch(tokens))} if tokens else set()
        if not marks or not seen.isdisjoint(marks):
            continue
        seen |= marks
        chains.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in tokens], np.int32))
        labels.append(int(label))
    y_doc = np.array(labels, int)
    n1, n0 = int(y_doc.sum()), int((1 - y_doc).sum())
    if not n1 or not n0:
        return empty
    table = np.zeros((len(vocabulary), SLOTS), np.int32)
    for i, t in enumerate(vocabulary):
        f = features(t)[:SLOTS]
        table[i, :len(f)] = f
    evidence = np.delete(table, 1, axis=1)  # words and beginnings
    carries = strong[evidence].any(axis=1)
    ends = np.cumsum([len(c) for c in chains])
    ids = np.concatenate(chains)
    first = np.zeros(len(ids), bool)
    first[np.concatenate(([0], ends[:-1]))] = True
    y = (carries[ids] & np.repeat(y_doc, np.diff(np.concatenate(([0], ends)))).astype(bool)).astype(float)
    model = Model(np.zeros(1 + (1 << HASH_BITS)), np.zeros(1), np.zeros((2, 2)), np.zeros(4), share)
    _climb(model, ids, first, y, table)
    scores = model.weights[table].sum(axis=1)[ids] + model.fields["bias"]
    p, _, _ = marginals(scores, first, model)
    model.doc = _logistic(doc_features(p, scores, ends), y_doc, np.where(y_doc == 1, share / n1, (1 - share) / n0) * len(labels))
    model.weights = model.weights.astype(np.float32)
    return model


def _climb(model: Model, ids: np.ndarray, first: np.ndarray, y: np.ndarray, table: np.ndarray) -> None:
    """Adaptive gradient ascent on the log-likelihood of the labelled token chains."""
    n = len(ids)
    base = float(np.log((y.sum() + 1) / (n + 1)))
    model.fields["bias"] = base
    model.start[:] = 0
    w2, s2, t2, b2 = np.full_like(model.weights, 1e-8), 1e-8, np.full((2, 2), 1e-8), 1e-8
    lab = y.astype(int)
    inner = np.flatnonzero(~first)
    pairs = np.bincount(2 * lab[inner - 1] + lab[inner], minlength=4).reshape(2, 2)
    for _ in range(ROUNDS):
        scores = model.weights[table].sum(axis=1)[ids] + model.fields["bias"]
        p, r, b = marginals(scores, first, model)
        miss = y - p
        of_type = np.bincount(ids, weights=miss, minlength=len(table))
        g = np.bincount(table.ravel(), weights=np.repeat(of_type, table.shape[1]), minlength=len(model.weights)) - RIDGE * n / 1000 * model.weights
        g[0] = 0
        e, t = np.exp(np.clip(scores[inner], -30, 30)), np.exp(model.step)
        before, after = r[inner - 1], b[inner]
        pair = [[t[0, 0], t[0, 1] * e * after], [before * t[1, 0], before * t[1, 1] * e * after]]
        total = ((pair[0][0] + pair[0][1]) + pair[1][0]) + pair[1][1]
        expected = np.array([[np.sum(x / total) for x in row] for row in pair])
        del pair, total, e, before, after
        gt = pairs - expected - RIDGE * n / 1000 * model.step
        gs, gb = miss[first].sum(), miss.sum()
        w2 += g * g
        t2 += gt * gt
        s2 += gs * gs
        b2 += gb * gb
        model.weights += RATE * g / np.sqrt(w2)
        model.step += RATE * gt / np.sqrt(t2)
        model.start += RATE * gs / np.sqrt(s2)
        model.fields["bias"] += RATE * gb / np.sqrt(b2)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - 0.01 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        move = np.linalg.solve(h, g)
        w += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return w


def distinct_words(rows: DataFrame) -> DataFrame:
    """(toxic, h, words): the distinct words of each labelled row with tokens; of near copies the one with the smallest h.

    ``rows`` has (text, toxic, h); near copies are rows of a class that share one of the two minima of ``_sketch``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in pieces_of(pc.binary_length(whole.column(0)).to_pylist(), 1_000_000):
                part = whole.slice(a, b - a)
                tokens = [TOKEN.findall(t) for t in part.column(0).to_pylist()]
                marks = [_sketch(t) if t else (None, None) for t in tokens]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
                     pa.array([" ".join(sorted(set(t))) for t in tokens], pa.string())], ["toxic", "h", "m0", "m1", "words"])

    each = rows.select("text", "toxic", "h").mapInArrow(run, "toxic int, h long, m0 long, m1 long, words string").where("m0 is not null")
    for key, other in (("m0", "m1"), ("m1", "m0")):
        each = each.groupBy("toxic", key).agg(F.min(F.struct("h", other, "words")).alias("x")).select("toxic", key, "x.*")
    return each.select("toxic", "h", "words")


def document_counts(words: DataFrame) -> DataFrame:
    """(feature, n1, n0, h): toxic and clean documents that hold a word or beginning, and the smallest h of the toxic ones.

    Feature 0 stands for the documents themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 1 + (1 << HASH_BITS)), np.int64)
        h = np.full(n.shape[1], np.iinfo(np.int64).max)
        known: dict[str, list[int]] = {}
        for batch in batches:
            for label, key, line in zip(*(c.to_pylist() for c in batch.columns)):
                own = {0}
                for w in line.split(" "):
                    f = known.get(w)
                    if f is None:
                        f = features(w)[:SLOTS]
                        f = known[w] = [f[0], *f[2:]]
                    own.update(f)
                at = np.fromiter(own, np.int64, len(own))
                n[label, at] += 1
                if label:
                    h[at] = np.minimum(h[at], key)
            if len(known) > 100_000:
                known.clear()
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, n[1, at], n[0, at], h[at])], ["feature", "n1", "n0", "h"])

    return words.select("toxic", "h", "words").mapInArrow(run, "feature long, n1 long, n0 long, h long") \
        .groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.min("h").alias("h"))


def _below(n: int, of: int) -> int:
    """The hash (a signed long) below which about ``n`` of ``of`` evenly spread ones lie."""
    return (1 << 63) - 1 if of <= n else (n << 64) // of - (1 << 63)


def _sampled(texts: DataFrame, ids: DataFrame, limit: int) -> list[tuple[str, int]]:
    """(text, toxic) of the chosen ids by hash, then id, up to ``limit`` bytes of text."""
    found = texts.join(F.broadcast(ids), "doc_id").withColumn("size", F.octet_length("text")).where(F.col("size") <= limit // 16) \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"), F.min("h").alias("h"), F.max("size").alias("size"))
    found = stored(found, "sample")
    taken, total = [], 0
    for r in found.select("doc_id", "size").orderBy("h", "doc_id").collect():  # a row for each id
        if total + r["size"] <= limit:
            taken.append(r["doc_id"])
            total += r["size"]
    sample = found.where(F.col("doc_id").isin(taken)).select("doc_id", "text", "toxic").toArrow()
    return [(text, label) for _, text, label in sorted(zip(*(sample.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))))]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 7, evidence_rows: int = EVIDENCE_ROWS,
        extra: int = EXTRA, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Learn from labelled documents (none with remainder 0): evidence from ``evidence_rows`` a class, weights from a sample."""
    marked = labels.where("doc_id is not null and toxic is not null").where(id_remainder("doc_id", HELD_OUT_MOD) != 0) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("h", F.xxhash64(F.lit(seed), "doc_id"))
    counts = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}  # two rows
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    strong = np.zeros(1 + (1 << HASH_BITS), bool)
    rows = max(evidence_rows, per_class)
    marked = stored(marked.where(" or ".join(f"(toxic = {int(c)} and h <= {_below(rows, n)})" for c, n in counts.items()) or "false"), "marked")
    texts = docs.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    # about evidence_rows ids of each class, so the broadcast is bounded; texts of other rows go no further than the scan
    found = stored(document_counts(distinct_words(texts.join(F.broadcast(marked), "doc_id"))), "evidence")
    every = found.where("feature = 0").head()
    picked, last = None, None
    for label in (0, 1):
        part = marked.where(F.col("toxic") == label).orderBy("h", "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
        last = part.agg(F.max("h")).head()[0]
    if every is not None and every["n1"] and every["n0"]:
        n1, n0 = every["n1"], every["n0"]
        good = found.where(f"feature > 0 and n1 >= {least(n1, n0)}").where(F.col("n1") / n1 >= 9 * (F.col("n0") + 0.5) / (n0 + 1))
        good = good.select("feature", "h").toArrow()
        strong[good.column("feature").to_numpy()] = True
        more = np.unique(good.column("h").to_numpy())
        more = more[more > last].tolist()[:extra]  # evidence that no document of the sample holds
        if more:
            wanted = docs.sparkSession.createDataFrame([(x,) for x in more], "h long")
            picked = picked.unionByName(marked.where("toxic = 1").join(wanted, "h", "left_semi").select(marked.columns))
    # at most 2 * per_class ids, and ``extra`` for evidence that they do not hold
    return train(_sampled(texts, picked, sample_bytes), share, strong)


SCHEMA = "score double, spans array<struct<begin:long,end:long,probability:double>>"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))


class _Scores(dict):
    """Token scores by token, computed on first use."""

    def __init__(self, model: Model):
        super().__init__()
        self.weights, self.bias = model.weights.tolist(), model.fields.get("bias", 0.0)

    def __missing__(self, token: str) -> float:
        w = self.weights
        out = self[token] = self.bias + sum([w[f] for f in features(token)[:SLOTS]])
        return out


def score_texts(texts: list[str | None], model: Model, scores: _Scores) -> tuple[np.ndarray, list[list[dict]]]:
    tokens = [TOKEN.findall(t) if t else [] for t in texts]
    ends = np.cumsum([len(t) for t in tokens])
    n = int(ends[-1]) if len(ends) else 0
    if not model.usable:
        return np.full(len(texts), model.share), [[] for _ in texts]
    p = s = np.zeros(0)
    if n:
        s = np.array([scores[x] for t in tokens for x in t])
        first = np.zeros(n, bool)
        begins = np.concatenate(([0], ends[:-1]))
        first[begins[begins < n]] = True
        p, _, _ = marginals(s, first, model)
    x = doc_features(p, s, ends)
    score = 1 / (1 + np.exp(-np.clip(x @ model.doc, -30, 30)))
    spans: list[list[dict]] = [[] for _ in texts]
    hot = np.flatnonzero(p >= 0.5)
    if len(hot):
        owner = np.searchsorted(ends, hot, side="right")
        for i in np.unique(owner).tolist():
            spans[i] = _spans(texts[i], p, hot[owner == i] - (ends[i] - len(tokens[i])), ends[i] - len(tokens[i]))
    return score, spans


def _spans(text: str, p: np.ndarray, positions: np.ndarray, offset: int) -> list[dict]:
    """Runs of consecutive tagged tokens as character ranges, with their mean marginal."""
    wanted, out, before = set(positions.tolist()), [], None
    for k, m in enumerate(TOKEN.finditer(text)):
        if k not in wanted:
            continue
        if before == k - 1:
            out[-1][1] = m.end()
            out[-1][2].append(p[offset + k])
        else:
            out.append([m.start(), m.end(), [p[offset + k]]])
        before = k
    return [{"begin": a, "end": b, "probability": float(np.mean(q))} for a, b, q in out]


def tag(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of ``docs`` plus score and spans, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = _Scores(model)
        for whole in batches:
            for a, b in pieces_of(pc.fill_null(pc.binary_length(whole.column(0)), 0).to_pylist(), 1_000_000):
                score, spans = score_texts(whole.column(0).slice(a, b - a).to_pylist(), model, scores)
                if len(scores) > 200_000:
                    scores.clear()
                yield pa.RecordBatch.from_arrays(
                    [*whole.slice(a, b - a).columns[1:], pa.array(score, pa.float64()), pa.array(spans, _SPANS)], [*keep, "score", "spans"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col(text_col).cast("string").alias("__text"), *keep).mapInArrow(run, f"{fields}, {SCHEMA}")


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` scored below one half, with their own columns."""
    model = fit(docs, labels, **options)
    packed = docs.select("text", F.struct(*docs.columns).alias("row"))  # the caller's columns cannot clash with the scores
    return tag(packed, model, ["row"]).where("score < 0.5").select("row.*")
