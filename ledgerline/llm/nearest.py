"""Approximate nearest neighbours by inner product: vantage-point trees per shard.

Inner products become distances: with M the greatest norm of a shard, a vector
x gets one more component sqrt(M^2 - |x|^2) and a query q a 0; then the squared
distance is |q|^2 + M^2 - 2 q . x, and the nearest vector is the one with the
greatest inner product.

Method. Vectors are dealt to shards of about ``shard_rows`` by a hash of their
id. A task gathers one shard at a time, makes equal vectors one point with its
ids, and builds a vantage-point tree: a node keeps a point, and the others in two
halves by their distance to it, with the least and greatest distance of each
half. The queries of a shard follow its vectors in the same sorted partition and
are answered in batches: by the triangle inequality a half with distances in
[low, high] holds nothing nearer to a query at distance d than max(low - d, d -
high, 0). A half is left out if that bound times ``factor`` is above the
distance of the query's k-th point so far. Factor 1 is the exact search;
greater factors leave out more, and the recall is measured in the tests.

Only (query, vector, score) of each shard's k best is shuffled after that. With
more than a few shards the queries visit about the root of the shard count
first; their k-th scores there are lower bounds that the other shards start
with, so that these return few rows each. Memory is one shard and one Arrow batch of
queries a task; nothing is broadcast or collected.

Scores are sums of products in double precision, added component after component,
so equal vectors score equally and any engine gets the same; candidates are compared with a margin
above the rounding of the matrix products that find them. Ties go to smaller
ids.

Defined cases: vectors that are null, empty or zero or that hold null or non-finite
components, and rows without an id, take no part; of rows with the same id the
least vector counts, once; a query is not its own candidate, but equal vectors
under other ids are; vectors are compared with those of their own length only;
fewer candidates than k give fewer rows; empty tables give empty results; no
other column is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

TOP, QUERY_EVERY = 20, 20
FACTOR = 1.05
SHARD_ROWS, LEAF = 16_384, 256
MARGIN = 1e-9


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): one finite, non-zero vector of doubles for each id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col("v")
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .where("id is not null and v is not null").where(F.forall(v, finite) & F.exists(v, lambda x: x != 0)) \
        .groupBy("id").agg(F.min("v").alias("v"))


class Tree:
    """A vantage-point tree over distinct vectors; each point has the ids of its vector, ascending, at most ``most``."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, most: int, leaf: int = LEAF):
        by = np.lexsort((ids, *x.T[::-1]))
        ids, x = ids[by], x[by]
        new = np.concatenate(([True], (x[1:] != x[:-1]).any(axis=1)))
        first = np.flatnonzero(new)
        self.x = x[first]
        ends = np.concatenate((first[1:], [len(ids)]))
        keep = np.minimum(ends - first, most)  # more than the k smallest ids and a query's own cannot be in a result
        self.id_start = np.concatenate(([0], np.cumsum(keep)))
        self.ids = ids[np.arange(self.id_start[-1]) + np.repeat(first - self.id_start[:-1], keep)]
        squares = (self.x * self.x).sum(axis=1)
        self.top = float(squares.max())
        self.lift = np.sqrt(np.maximum(0, self.top - squares))
        self.order = np.arange(len(self.x))
        # node: (low, high, vantage point, children or None); children: (node, least distance, greatest distance)
        self.nodes: list[tuple] = []
        self.leaf = leaf
        self._build()
        # in tree order, a leaf is one block
        self.x, self.lift = self.x[self.order], self.lift[self.order]
        self.id_start, self.ids = self._ids_in_order()

    def _ids_in_order(self) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(self.id_start)[self.order]
        starts = np.concatenate(([0], np.cumsum(n)))
        return starts, self.ids[np.arange(starts[-1]) + np.repeat(self.id_start[:-1][self.order] - starts[:-1], n)]

    def _build(self) -> None:
        todo = [(0, len(self.order))]
        while todo:
            a, b = todo.pop()
            if b - a <= self.leaf:
                self.nodes.append((a, b, None))
                continue
            # the point farthest from the first one; it comes first in the node's range
            d = self._distances(self.order[a], self.order[a:b])
            far = a + int(d.argmax())
            self.order[a], self.order[far] = self.order[far], self.order[a]
            d = self._distances(self.order[a], self.order[a + 1:b])
            middle = len(d) // 2
            by = np.argpartition(d, middle)
            self.order[a + 1:b], d = self.order[a + 1:b][by], d[by]
            cut = a + 1 + middle
            near, rest = d[:middle], d[middle:]
            self.nodes.append((a, b, (cut, float(near.min()), float(near.max()), float(rest.min()), float(rest.max()))))
            todo += [(cut, b), (a + 1, cut)]

    def _distances(self, point: int, others: np.ndarray) -> np.ndarray:
        gap = self.x[others] - self.x[point]
        return np.sqrt((gap * gap).sum(axis=1) + (self.lift[others] - self.lift[point]) ** 2)


class Search:
    """The k best points of a batch of queries, over one tree."""

    def __init__(self, tree: Tree, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, factor: float):
        self.tree, self.own, self.q, self.k, self.factor = tree, ids, q, k, factor
        self.floor = floor.copy()  # a result has at least this score
        self.size = (q * q).sum(axis=1)
        self.slack = MARGIN * (np.sqrt(self.size * tree.top) + 1e-300)
        n = len(ids)
        self.score = np.full((n, k), -np.inf)
        self.found = np.full((n, k), np.iinfo(np.int64).max)
        self.scored = 0
        self.place = {(a, b): i for i, (a, b, _) in enumerate(tree.nodes)}
        if n:
            self._visit(0, np.arange(n))

    def reach(self, who: np.ndarray) -> np.ndarray:
        """Distance beyond which nothing can enter a query's result."""
        return np.sqrt(np.maximum(0, self.size[who] + self.tree.top - 2 * (self.floor[who] - self.slack[who])))

    def _visit(self, node: int, who: np.ndarray) -> None:
        a, b, split = self.tree.nodes[node]
        if split is None:
            self._enter(a, b, who)
            return
        self._enter(a, a + 1, who)
        cut, *spans = split
        s = self.q[who] @ self.tree.x[a]
        d = np.sqrt(np.maximum(0, self.size[who] + self.tree.top - 2 * s))
        sides = [self.place[(a + 1, cut)], self.place[(cut, b)]]
        least = [np.maximum(0, np.maximum(low - d, d - high)) for low, high in (spans[:2], spans[2:])]
        # each query takes the half that can hold nearer points first; equal bounds: the half on its side of the cut
        first = np.where(least[0] == least[1], d > (spans[1] + spans[2]) / 2, least[1] < least[0])
        for turn in (0, 1):
            for side in (0, 1):
                mine = first == (side ^ turn)
                # the bound is lowered by more than its rounding error; nothing equal is left out
                open_ = mine & (least[side] * self.factor * (1 - MARGIN) <= self.reach(who) + 1e-7 * math.sqrt(self.tree.top))
                if open_.any():
                    self._visit(sides[side], who[open_])

    def _enter(self, a: int, b: int, who: np.ndarray) -> None:
        tree, k = self.tree, self.k
        s = self.q[who] @ tree.x[a:b].T
        self.scored += s.size
        bar = self.floor[who]
        if b - a > k:  # k points of these other than its own: no score below the (k + 1)-th can enter
            bar = np.maximum(bar, np.partition(s, b - a - k - 1, axis=1)[:, b - a - k - 1])
        row, point = np.nonzero(s >= (bar - self.slack[who])[:, None])
        if not len(row):
            return
        exact = np.cumsum(self.q[who[row]] * tree.x[a + point], axis=1)[:, -1]  # component after component
        n = np.diff(tree.id_start)[a + point]
        at = np.arange(n.sum()) + np.repeat(tree.id_start[a + point] - (np.cumsum(n) - n), n)
        row, ids, exact = np.repeat(who[row], n), tree.ids[at], np.repeat(exact, n)
        good = (ids != self.own[row]) & (exact >= self.floor[row])
        row, ids, exact = row[good], ids[good], exact[good]
        if not len(row):
            return
        changed = np.unique(row)
        row = np.concatenate((row, np.repeat(changed, k)))
        ids = np.concatenate((ids, self.found[changed].ravel()))
        exact = np.concatenate((exact, self.score[changed].ravel()))
        by = np.lexsort((ids, -exact, row))
        row, ids, exact = row[by], ids[by], exact[by]
        begin = np.searchsorted(row, changed)
        take = (begin[:, None] + np.arange(k)).ravel()
        self.score[changed], self.found[changed] = exact[take].reshape(-1, k), ids[take].reshape(-1, k)
        self.floor[changed] = np.maximum(self.floor[changed], self.score[changed, -1])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


_FOUND = "query_id long, vec_id long, score double"


def _search_shards(rows: DataFrame, k: int, factor: float, leaf: int) -> DataFrame:
    """(query_id, vec_id, score) of partitions sorted by (width, shard, part): vectors (part 0), then queries (part 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, None
        ids: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                width, shard, part = keys[a].tolist()
                if (width, shard) != key:
                    key, tree, ids, parts = (width, shard), None, [], []
                own = batch.column(3).slice(a, b - a).to_numpy()
                x = _matrix(batch.column(4).slice(a, b - a), width)
                if part == 0:
                    ids.append(own)
                    parts.append(x)
                    continue
                if not ids and tree is None:
                    continue  # queries of a shard without vectors
                if tree is None:
                    tree, ids, parts = Tree(np.concatenate(ids), np.concatenate(parts), k + 1, leaf), [], []
                floor = batch.column(5).slice(a, b - a).to_numpy(zero_copy_only=False)
                done = Search(tree, own, x, floor, k, factor)
                good = done.score > -np.inf
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, good.sum(axis=1))), pa.array(done.found[good]), pa.array(done.score[good])],
                    ["query_id", "vec_id", "score"])

    ordered = rows.select("width", "shard", "part", "id", "v", "floor")
    return ordered.mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column | str, k: int = TOP, factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
            leaf: int = LEAF, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` (a condition on ``id``) marks, its ``k`` nearest others."""
    if factor < 1:
        raise ValueError("factor must be at least 1")
    points = stored(usable(vectors, id_col, vector_col).withColumn("width", F.size("v")), "vectors")
    shards = -(-points.count() // shard_rows) or 1
    shard = F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(shards)).cast("int")
    queries = points.where(is_query)
    none = F.lit(float("-inf"))
    candidates = points.withColumns({"shard": shard, "part": F.lit(0), "floor": none})
    first = shards if shards <= 8 else math.isqrt(shards - 1) + 1

    def visit(low: int, high: int, asked: DataFrame) -> DataFrame:
        spread = asked.withColumns({"shard": F.explode(F.sequence(F.lit(low), F.lit(high - 1))), "part": F.lit(1)})
        rows = candidates.where((F.col("shard") >= low) & (F.col("shard") < high)).unionByName(spread)
        # a task for every shard (a hash of the shard would put several into one)
        placed = rows.repartitionById(high - low, (F.col("shard") - low).cast("int")).sortWithinPartitions("width", "shard", "part")
        return stored(_search_shards(placed, k, factor, leaf), "found")

    found = visit(0, first, queries.withColumn("floor", none))
    if first < shards:
        best = _best(found, k)
        bars = best.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        asked = queries.join(bars, "id", "left").withColumn("floor", F.coalesce("floor", none))
        found = best.drop("rank").unionByName(visit(first, shards, asked))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
