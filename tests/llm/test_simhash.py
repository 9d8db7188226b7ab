import numpy as np
import pytest
import xxhash
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import simhash as S
from llm.conftest import as_rows


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Smallest id reachable over links of at most 3 bits; prints: [(id, fp)]."""
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [least.get(top(k)) for k in range(len(prints))]


def unsigned(fp):
    return fp & (2 ** 64 - 1)


def test_prints_and_groups_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = dict(docs.collect())
    got = {r["doc_id"]: r for r in S.near_duplicates(docs).collect()}
    prints = [(i, brute_print(t)) for i, t in sorted(texts.items())]
    assert [(i, unsigned(got[i]["fp"])) for i, _ in prints] == prints
    assert [got[i]["component_id"] for i, _ in prints] == brute_groups(prints)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    prints = [(i, brute_print(t)) for i, t in rows]
    want = sorted(((i, p, c) for (i, p), c in zip(prints, brute_groups(prints))), key=repr)
    got = sorted(((r["doc_id"], unsigned(r["fp"]), r["component_id"]) for r in S.near_duplicates(edge_docs).collect()), key=repr)
    assert got == want
    assert S.near_duplicates(no_docs).collect() == []


def test_keep_first_keeps_one_row_of_each_group(spark, edge_docs, no_docs):
    kept = S.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    groups = {r["component_id"] for r in S.near_duplicates(edge_docs).collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted(groups, key=repr) and len(ids) == len(set(ids))
    assert S.keep_first(no_docs).collect() == []


def test_same_id_with_different_texts_is_judged_row_by_row(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha beta gamma delta"), (2, "other words stand in this row")], "doc_id long, text string")
    assert as_rows(S.keep_first(docs)) == [(1, "alpha beta gamma delta"), (2, "other words stand in this row")]


@pytest.mark.parametrize("block_rows", [40, 20_000])
def test_dense_groups_give_the_same_components_in_blocks(spark, block_rows):
    rng = np.random.default_rng(3)
    center = int(rng.integers(1, 2 ** 62))
    fps = {center} | {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (60, 2))}
    fps |= {int(x) for x in rng.integers(0, 2 ** 63 - 1, 100)}
    signed = [int(np.array([f], np.uint64).view(np.int64)[0]) for f in sorted(fps)]
    distinct = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, low long")
    roots = dict(as_rows(S.print_roots(distinct, 3, block_rows)))
    want = brute_groups([(i, unsigned(f)) for i, f in enumerate(signed)])
    mine = {}
    for i, f in enumerate(signed):
        mine.setdefault(roots[f], []).append(i)
    assert sorted(mine.values()) == sorted([i for i in range(len(signed)) if want[i] == w] for w in set(want))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_every_close_pair_shares_a_chain_key(a, flips):
    b = a
    for f in flips:
        b ^= 1 << f
    keys, home = S._chain_keys(np.array([a, b], np.uint64))
    shared = [k for k in keys[0][home[0]].tolist() if k in keys[1].tolist()]
    assert any(S._near(np.array([a], np.uint64), np.array([b], np.uint64), np.array([k >> 32], np.uint64), 3)[0] for k in shared)


def test_chain_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert dict(as_rows(S.components(edges))) == {i: 0 for i in range(1, 61)}
