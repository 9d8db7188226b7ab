"""Vantage-point search: exact at factor one, recall at the production factor, shards, ties, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import nearest
from ledgerline.llm.queries import QUERIES

IS_QUERY = "pmod(id, 20) = 0"


def slow(rows, k=20, every=20):
    """Every candidate of every query; ids and vectors as the operator defines them."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = min(good.get(i, tuple(v)), tuple(v))
    out = []
    for q in sorted(good):
        if q % every == 0:
            a = np.array(good[q])
            near = sorted((-(a * np.array(v)).sum(), i) for i, v in good.items() if i != q and len(v) == len(a))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    return out


def same(got, want):
    got = sorted(tuple(r) for r in got.collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=1e-12)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s") for i, v in rows], "vec_id long, embedding array<double>, label int, score string")


def made(n, seed=0, width=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * rng.uniform(0.2, 3, size=(n, 1))
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("shard_rows", [5000, 150, 40])
def test_factor_one_is_exact(spark, shard_rows):
    """One shard, a few, and enough for two rounds of visits."""
    rows = made(700)
    same(nearest.nearest(frame(spark, rows), IS_QUERY, factor=1.0, shard_rows=shard_rows, leaf=16), slow(rows))


def test_equal_vectors_tie_by_id(spark):
    rows = made(60, 1) + [(100 + i, [1.0, 2.0] * 4) for i in range(300)]  # more copies than k under other ids
    for leaf in (8, 512):
        same(nearest.nearest(frame(spark, rows), IS_QUERY, factor=1.0, shard_rows=90, leaf=leaf), slow(rows))


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, []), (80, [1.0, None]), (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [-1.0, 3.0]), (3, [1.0]), (140, [2.0]), (160, [1.0, 2.0, 3.0]), (0, [1.0, 0.0])]
    same(nearest.nearest(frame(spark, rows), IS_QUERY, factor=1.0), slow(rows))
    assert nearest.nearest(frame(spark, rows).where("false"), IS_QUERY).count() == 0
    with pytest.raises(ValueError, match="factor"):
        nearest.nearest(frame(spark, rows), IS_QUERY, factor=0.5)


def test_pruning_saves_work_on_clustered_vectors():
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(40, 16)) * 4
    x = centers[rng.integers(40, size=8000)] + rng.normal(size=(8000, 16)) * 0.2
    ids = np.arange(8000)
    tree = nearest.Tree(ids, x, 21, leaf=64)
    none = np.full(400, -np.inf)
    exact = nearest.Search(tree, ids[::20], x[::20], none, 20, 1.0)
    s = x[::20] @ x.T
    s[np.arange(400), ids[::20]] = -np.inf
    want = np.argsort(-s, axis=1, kind="stable")[:, :20]
    assert (np.sort(exact.found, axis=1) == np.sort(want, axis=1)).all()
    relaxed = nearest.Search(tree, ids[::20], x[::20], none, 20, nearest.FACTOR)
    assert relaxed.scored < exact.scored < s.size
    hits = sum(len(set(a) & set(b)) for a, b in zip(relaxed.found.tolist(), want.tolist()))
    assert hits >= 0.9 * want.size


def test_production_recall_on_the_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op13_nearest_neighbours"](spark, sf).collect()
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>")).collect()]
    want = slow(rows)
    assert len(got) == len(want)
    hits = {(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in want}
    assert len(hits) >= 0.97 * len(want)
    by = {i: np.array(v) for i, v in rows}
    assert all(abs(r["score"] - (by[r["query_id"]] * by[r["vec_id"]]).sum()) < 1e-12 for r in got)
    for a, b in zip(sorted(got), sorted(got)[1:]):
        assert a["query_id"] != b["query_id"] or (b["rank"] == a["rank"] + 1 and (-a["score"], a["vec_id"]) < (-b["score"], b["vec_id"]))
