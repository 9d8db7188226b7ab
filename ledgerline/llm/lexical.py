"""Ranked lexical search: exact inner-product search in ball trees of sparse document vectors.

A document is a vector over the terms of the items: component (10^9 tf) div
(1000 tf + 12 m) for a term that occurs tf times, where m rises with the
document's length; an item is a vector of term weights, repeats added. The score
is their inner product, in 64-bit integers.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``
with A-Z lower-cased. N counts the documents with a term, L all their terms, n
those of one document, df the documents that hold a term; w = floor(1000 ln((2 N
+ 2) / (2 df + 1))) in doubles, m = 75 + (25 n N) div L.

Method. One pass turns every whole text into (doc_id, n, terms, counts) over the
item terms and stores these narrow rows; N, L and df are aggregated from them.
A second pass takes the stored rows in blocks. Each block becomes a ball tree:
a node is a stretch of documents with their centroid c and the radius r of the
ball around c that holds them, and for each term the greatest component (the
centroid's plus the radius in that direction); its children are the documents nearer to one of
two far documents and those nearer to the other (or halves along that line, if
one side would be too small). For an item q no document of a node scores above q . c + |q| r,
nor above the sum of q's weights times the greatest components; the smaller of
both is the node's bound. The tree is searched best-first: the node with the greatest bound is opened
next, leaves are scored exactly, and the search of a block ends when the
greatest bound left is below the item's k-th score so far (which is kept from
block to block). Bounds are doubles; they are raised by more than their rounding
error, so no document is lost, and equal scores are never pruned.

A task keeps k rows an item, so what is shuffled is tasks x items x k short rows.
The items are read in groups of at most ``group_bytes`` of text (one group
unless the item table is larger), each with a pass of its own: the broadcast
weights and the tasks' state are bounded by that parameter. A block holds at
most ``BLOCK`` documents, fewer if the item terms are many, so its tree is
bounded too.

Defined cases: null and empty texts have no terms, count in neither N nor L and
are never found; every row is a document of its own, so repeated rows are
ranked one after the other; null ids come after all others among equal scores;
every item row is ranked for itself, also null and repeated ids; items without
terms have no result rows; empty tables give empty results; no other column is
read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import pieces_of, stored

TOP = 20
BLOCK, LEAF, CELLS = 8192, 32, 8_000_000
GROUP_BYTES = 32_000_000
# bytes that belong to terms: digits, letters and all bytes of other scripts; A-Z become a-z
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | bytes | None) -> list[bytes]:
    """The terms of a text, as UTF-8."""
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return raw.translate(_TABLE).split()


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term; ``terms`` are the vocabulary's, ascending."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    lists = (pa.list_(pa.int32()), pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, size = shared.value.get, max(1, len(shared.value))
        for whole in batches:
            raw = whole.column(0).cast(pa.binary())
            for a, b in pieces_of(pc.fill_null(pc.binary_length(raw), 0).to_pylist(), 4_000_000):
                found = [terms_of(x) for x in raw.slice(a, b - a).to_pylist()]
                known = [[t for t in map(get, words) if t is not None] for words in found]
                flat = np.fromiter((t for x in known for t in x), np.int64)
                owner = np.repeat(np.arange(len(known)), [len(x) for x in known])
                cells, tf = np.unique(owner * size + flat, return_counts=True)
                ends = pa.array(np.searchsorted(cells, np.arange(len(known) + 1) * size), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [whole.column(1).slice(a, b - a), pa.array([len(x) for x in found], pa.int64()),
                     *(pa.ListArray.from_arrays(ends, pa.array(x, t.value_type)) for x, t in zip((cells % size, tf), lists))],
                    ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")) \
        .mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>").where("n > 0")


@dataclass
class Tree:
    """A ball tree over documents in the order of ``order``; node i holds the documents [low, high) of that order."""

    order: np.ndarray
    starts: np.ndarray  # cells of the ordered documents
    terms: np.ndarray
    values: np.ndarray
    low: list[int]
    high: list[int]
    child: list[int]  # the first of two children that follow each other, -1 for a leaf
    centroids: np.ndarray
    radius: np.ndarray
    tops: np.ndarray  # greatest component of each term


def _cells(starts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell positions, starts) of some documents, in their order."""
    n = starts[docs + 1] - starts[docs]
    begins = np.concatenate(([0], np.cumsum(n)))
    return np.arange(begins[-1]) + np.repeat(starts[docs] - begins[:-1], n), begins


def _dots(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of each document's cells (every document has one)."""
    return np.add.reduceat(values, starts[:-1])


def build(starts: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int, leaf: int = LEAF) -> Tree:
    """A ball tree over sparse documents: cells [starts[i], starts[i + 1]) belong to document i, none is empty."""
    vals = values.astype(float)
    n = len(starts) - 1
    norms = _dots(vals * vals, starts)
    order = np.arange(n)
    low, high, child, centroids, radius = [0], [n], [-1], [], []
    node = 0
    while node < len(low):
        a, b = low[node], high[node]
        docs = order[a:b]
        at, begins = _cells(starts, docs)
        t, v = terms[at], vals[at]
        c = np.bincount(t, v, n_terms) / (b - a)
        size = float(c @ c)
        far = norms[docs] - 2 * _dots(v * c[t], begins) + size
        centroids.append(c)
        # raised by more than the rounding of the three terms
        radius.append(math.sqrt(max(0.0, float(far.max())) + 1e-11 * (float(norms[docs].max()) + size)))
        if b - a > leaf:
            first = docs[int(far.argmax())]
            p = np.zeros(n_terms)
            p[terms[starts[first]:starts[first + 1]]] = vals[starts[first]:starts[first + 1]]
            away = norms[docs] - 2 * _dots(v * p[t], begins)
            second = docs[int(away.argmax())]
            p[terms[starts[second]:starts[second + 1]]] -= vals[starts[second]:starts[second + 1]]
            along = _dots(v * p[t], begins)
            nearer = along > (norms[first] - norms[second]) / 2
            middle = (b - a) - int(nearer.sum())
            if min(middle, b - a - middle) < leaf // 2:  # too small a side: halves
                middle = (b - a) // 2
                order[a:b] = docs[np.argpartition(along, middle)]
            else:
                order[a:b] = np.concatenate((docs[~nearer], docs[nearer]))
            child[node] = len(low)
            low += [a, a + middle]
            high += [a + middle, b]
            child += [-1, -1]
        node += 1
    at, begins = _cells(starts, order)
    terms, values = terms[at], values[at]
    tops = np.zeros((len(low), n_terms), np.int32)  # components are below 10^6
    for node in reversed(range(len(low))):
        if (c := child[node]) >= 0:
            np.maximum(tops[c], tops[c + 1], out=tops[node])
        else:
            cells = slice(begins[low[node]], begins[high[node]])
            np.maximum.at(tops[node], terms[cells], values[cells].astype(np.int32))
    return Tree(order, begins, terms, values, low, high, child, np.array(centroids), np.array(radius), tops)


class Best:
    """The k greatest (score, smaller id first) of an item."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int:
        """Scores below this one cannot enter."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc: int | None) -> None:
        entry = (score, -math.inf if doc is None else -doc)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def rows(self) -> list[tuple[int, int | None]]:
        return [(s, None if d == -math.inf else -d) for s, d in self.heap]


def search(tree: Tree, ids: list[int | None], at: np.ndarray, weights: np.ndarray, best: Best, dense: np.ndarray) -> int:
    """Enter the tree's documents into ``best``, best-first; returns the number of documents scored.

    ``at`` and ``weights`` are the item's terms; ``dense`` is a zero array over all terms (left as it was).
    """
    if not len(at):
        return 0
    w = weights.astype(float)
    length = math.sqrt(float(w @ w))
    dense[at] = weights

    def bounds(nodes: slice) -> list[float]:
        # the factor and the one are far above the rounding error of sums of products below 2^63
        ball = (tree.centroids[nodes][:, at] @ w + length * tree.radius[nodes]) * (1 + 1e-9) + 1
        return np.minimum(ball, (tree.tops[nodes][:, at] @ weights) * (1 + 1e-9)).tolist()

    queue, scored = [(-bounds(slice(0, 1))[0], 0)], 0
    while queue and -queue[0][0] >= best.least():
        _, node = heapq.heappop(queue)
        if (c := tree.child[node]) >= 0:
            for i, bound in enumerate(bounds(slice(c, c + 2))):
                if bound >= best.least():
                    heapq.heappush(queue, (-bound, c + i))
            continue
        a, b = tree.low[node], tree.high[node]
        cells = slice(tree.starts[a], tree.starts[b])
        scores = np.add.reduceat(tree.values[cells] * dense[tree.terms[cells]], tree.starts[a:b] - tree.starts[a])
        scored += b - a
        for i in np.flatnonzero(scores >= best.least()).tolist():
            best.add(int(scores[i]), ids[tree.order[a + i]])
    dense[at] = 0
    return scored


def impacts(n: np.ndarray, tf: np.ndarray, total: int, length: int) -> np.ndarray:
    """The components (10^9 tf) div (1000 tf + 12 m) for term counts tf in documents of n terms."""
    m = 100 - 25 + (25 * n * total) // max(1, length)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def search_counted(counted: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], n_terms: int, total: int, length: int,
                   k: int = TOP, block: int = BLOCK) -> DataFrame:
    """(item, doc_id, score): for each task the ``k`` best documents of every item."""
    shared = counted.sparkSession.sparkContext.broadcast(items)
    block = max(LEAF, min(block, CELLS * LEAF // (4 * max(1, n_terms))))  # a tree has at most 4 nodes for LEAF documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best = [Best(k) for _ in items]
        dense = np.zeros(n_terms, np.int64)
        held: list[pa.RecordBatch] = []

        def enter(part: pa.Table) -> None:
            sizes = part.column("terms").combine_chunks()
            n = np.diff(sizes.offsets.to_numpy())
            tf = part.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
            values = impacts(np.repeat(part.column("n").to_numpy(), n), tf, total, length)
            tree = build(np.concatenate(([0], np.cumsum(n))), sizes.flatten().to_numpy().astype(np.int64), values, n_terms)
            ids = part.column("doc_id").to_pylist()
            for (_, at, weights), b in zip(items, best):
                search(tree, ids, at, weights, b, dense)

        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= block:
                joined = pa.Table.from_batches(held).combine_chunks()
                enter(joined.slice(0, block))
                held, rows = joined.slice(block).to_batches(), rows - block
        if rows:
            enter(pa.Table.from_batches(held).combine_chunks())
        out = [(item, d, s) for (item, _, _), b in zip(items, best) for s, d in b.rows()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["item", "doc_id", "score"])

    return counted.where("size(terms) > 0").mapInArrow(run, "item long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, group_bytes: int = GROUP_BYTES, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the greatest score above 0 of every item row."""
    listed = stored(items.select("item_id", F.col("text").cast("string").alias("text")).withColumn("item", F.monotonically_increasing_id()), "items")
    size = listed.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    groups = -(-size // group_bytes) or 1
    out = None
    for g in range(groups):
        # at most group_bytes of text on average: consecutive item numbers go round the groups
        some = listed.where(F.pmod("item", F.lit(groups)) == g).select("item", "text").toArrow()
        words = [terms_of(x) for x in some.column("text").to_pylist()]
        vocabulary = {t: i for i, t in enumerate(sorted({t for x in words for t in x}))}
        counted = stored(count_terms(docs, vocabulary), "counted")
        total, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).head()
        df = counted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # a row for each item term
        weight = np.zeros(len(vocabulary), np.int64)
        for t, n in zip(df.column("t").to_pylist(), df.column("count").to_pylist()):
            weight[t] = math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1)))
        vectors = []
        for item, x in zip(some.column("item").to_pylist(), words):
            at, times = np.unique(np.array([vocabulary[t] for t in x], np.int64), return_counts=True)
            w = weight[at] * times
            vectors.append((item, at[w > 0], w[w > 0]))
        part = search_counted(counted, vectors, len(vocabulary), total, length, k, block)
        out = part if out is None else out.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(listed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
