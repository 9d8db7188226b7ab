"""Ball-tree search against plain scoring of every document, bounds, blocks, groups of items, edge rows."""

import math
import random
import re
from collections import Counter

import numpy as np

from ledgerline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_rank(docs, items, k=20):
    """Scores of every document for every item, by loops."""
    words = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    total, length = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        q, scores = TERM.findall((text or "").translate(LOWER)), []
        for d, w in words:
            tf, s = Counter(w), 0
            for t in q:
                if tf[t]:
                    m = 100 - 25 + (25 * len(w) * total) // length
                    s += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "Ab", "x-y"]
    docs = [(i, " ".join(rng.choice(words[:rng.choice([5, 20, 64])]) for _ in range(rng.randrange(0, 60)))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(70)]  # copies: equal scores
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))) for i in range(12)]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string"), \
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")


def same(got, want):
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_equals_plain_scoring_in_any_blocks(spark):
    docs, items = corpus(1, 300)
    d, i = frames(spark, docs, items)
    want = slow_rank(docs, items)
    same(lexical.rank(d, i), want)
    same(lexical.rank(d.repartition(5), i, block=64), want)


def test_groups_of_items(spark):
    docs, items = corpus(2, 120)
    d, i = frames(spark, docs, items)
    same(lexical.rank(d, i, k=5, group_bytes=60), slow_rank(docs, items, 5))


def test_edge_rows(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    items = [(1, "one two"), (None, "ONE three É"), (1, "one two"), (2, None), (3, ""), (4, "..."), (5, "zzz"), (6, "w x a")]
    _, i = frames(spark, [(0, "")], items)
    same(lexical.rank(edge_docs, i), slow_rank(docs, items))
    assert lexical.rank(no_docs, i).count() == 0
    assert lexical.rank(edge_docs, i.where("false")).count() == 0


def test_bounds_prune_and_lose_nothing():
    """Close groups of vectors: most documents are never scored, the best are those of a full scan."""
    rng = np.random.default_rng(4)
    n_terms, groups = 400, 40
    rows = []
    for g in range(groups):
        own = rng.choice(n_terms, 12, replace=False)
        for _ in range(50):
            rows.append({int(t): int(v) for t, v in zip(own, rng.integers(500_000, 520_000, 12))})
    rng.shuffle(rows)
    starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    terms = np.array([t for r in rows for t in sorted(r)])
    values = np.array([r[t] for r in rows for t in sorted(r)])
    tree = lexical.build(starts, terms, values, n_terms)
    dense, scored = np.zeros(n_terms, np.int64), 0
    for _ in range(30):
        at = np.sort(np.array(list(rows[int(rng.integers(len(rows)))])))
        w = rng.integers(1000, 9000, len(at))
        best = lexical.Best(10)
        scored += lexical.search(tree, list(range(len(rows))), at, w, best, dense)
        weight = dict(zip(at.tolist(), w.tolist()))
        full = sorted(((sum(weight.get(t, 0) * v for t, v in r.items()), -i) for i, r in enumerate(rows)), reverse=True)[:10]
        assert sorted(best.rows(), key=lambda r: (-r[0], r[1])) == [(s, -i) for s, i in full]
        assert not dense.any()
    assert scored < 0.2 * 30 * len(rows)


def test_every_document_lies_in_its_balls():
    rng = np.random.default_rng(5)
    n = rng.integers(1, 20, 500)
    starts = np.concatenate(([0], np.cumsum(n)))
    terms = np.concatenate([np.sort(rng.choice(50, x, replace=False)) for x in n])
    values = rng.integers(1, 1_000_000, len(terms))
    tree = lexical.build(starts, terms, values, 50)
    full = np.zeros((500, 50))
    full[np.repeat(np.arange(500), n), terms] = values
    assert sorted(tree.order.tolist()) == list(range(500))
    for a, b, c, r in zip(tree.low, tree.high, tree.centroids, tree.radius):
        assert (np.linalg.norm(full[tree.order[a:b]] - c, axis=1) <= r).all()
