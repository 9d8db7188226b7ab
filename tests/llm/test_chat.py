import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from conftest import SMALL

from ledgerline.llm import chat as C
from llm.conftest import as_rows

TEXT = st.lists(st.sampled_from(list("ab \\[]<>/s") + ["[INST]", "[/INST]", "</s>", "<s>", "[OUT] ", "[TURN x]", "[/TURN]", "é"]), max_size=12).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool]", "a\\"]), TEXT)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
def test_every_conversation_reads_back(turns):
    formatted, mask = C.format_turns(turns)
    assert C.parse_turns(formatted) == turns
    assert [C.unescape(formatted[a:a + n]) for a, n in mask] == [t for r, t in turns if r == "assistant"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_linear_conversations(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet")
    got = {r["conv_id"]: r for r in C.read_back(C.format_paths(C.linear_nodes(rows)).withColumnRenamed("tree", "conv_id"), ["conv_id"]).collect()}
    by = {}
    for r in sorted(rows.collect(), key=lambda r: (r["conv_id"], r["turn"])):
        by.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    assert set(got) == set(by)
    for i, turns in by.items():
        assert got[i]["n_turns"] == len(turns)
        assert got[i]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert got[i]["loss_sha256"] == sha("".join(t for r, t in turns if r == "assistant"))


def test_edge_conversations(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", None), (1, 1, None, "x"), (2, None, "user", "a"), (2, 5, "assistant", "b"), (2, 5, "assistant", "b"), (None, 0, "user", "n"),
         (None, 1, "assistant", "z" * 100_000)], "conv_id long, turn long, role string, text string").selectExpr("*", "1 as score", "'q' as tree", "2 as node")
    out = {r["tree"]: C.parse_turns(r["formatted"]) for r in C.format_paths(C.linear_nodes(rows)).collect()}
    assert out[1] == [("user", ""), ("", "x")] and out[2] == [("user", "a"), ("assistant", "b"), ("assistant", "b")]
    assert out[None] == [("user", "n"), ("assistant", "z" * 100_000)]
    assert C.format_paths(C.linear_nodes(rows.where("false"))).collect() == []


def test_paths_of_random_trees_match_a_walk(spark):
    import random

    rng, rows = random.Random(5), []
    for tree in range(6):
        for node in range(rng.randint(1, 40)):
            rows.append((tree, node, None if node == 0 else rng.randrange(node) if tree % 2 else node - 1, f"r{node}", f"t{node}", rng.random()))
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    parent = {(t, n): p for t, n, p, *_ in rows}
    score = {(t, n): s for t, n, *_, s in rows}
    inner = {(t, p) for (t, _), p in parent.items()}
    want, best = set(), {}
    for t, n in parent:
        if (t, n) in inner:
            continue
        path, at = [], n
        while at is not None:
            path.append(at)
            at = parent[t, at]
        want |= {(n, x, up) for up, x in enumerate(path)}
        key = (-sum(score[t, x] for x in path) / len(path), -len(path), n)
        best[t] = min(best.get(t, (key, [])), (key, [f"t{x}" for x in reversed(path)]), key=lambda x: (x[0], -len(x[1])))
    assert {(r["leaf"], r["node"], r["up"]) for r in C.paths(nodes).collect()} == want
    got = {r["tree"]: [t for _, t in C.parse_turns(r["formatted"])] for r in C.format_paths(nodes).collect()}
    assert got == {t: p for t, (_, p) in best.items()}
    assert C.format_paths(nodes, per_tree=1000).count() == len({(t, n) for t, n in parent if (t, n) not in inner})


def test_missing_parents_are_roots_and_cycles_raise(spark, monkeypatch):
    schema = "tree long, node long, parent long, role string, text string, score double"
    lost = spark.createDataFrame([(1, 2, 99, "user", "a", 0.0), (1, 3, 2, "assistant", "b", 0.0)], schema)
    assert [C.parse_turns(r["formatted"]) for r in C.format_paths(lost).collect()] == [[("user", "a"), ("assistant", "b")]]
    monkeypatch.setattr(C, "_MAX_ROUNDS", 4)
    with pytest.raises(ValueError):
        C.paths(spark.createDataFrame([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0)], schema))


def nodes_of(spark, rows):
    return spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")


def test_replies_to_a_cycle_raise_after_few_rounds(spark, monkeypatch):
    """A long chain of replies that hangs off a cycle: rows do not double, and the error comes in log2 of the tree's size."""
    kept = []
    monkeypatch.setattr(C, "stored", lambda df, label, stored=C.stored: kept.append(stored(df, label)) or kept[-1])
    rows = [(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0)] + [(1, n, n - 1, "u", "c", 0.0) for n in range(3, 31)]
    with pytest.raises(ValueError, match="cycle"):
        C.format_paths(nodes_of(spark, rows))
    assert len(kept) <= 7 and all(t.count() <= len(rows) for t in kept)


def test_a_long_thread_with_replies_lists_only_chosen_paths(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(C, "stored", lambda df, label, stored=C.stored: kept.setdefault(label, []).append(stored(df, label)) or kept[label][-1])
    n = 10_000
    rows = [(1, i, i - 1 if i else None, "user", f"t{i}", 1.0) for i in range(n)]
    rows += [(1, n + i, i, "assistant", "reply", 0.0) for i in range(n - 1)]  # a reply at each step
    out = C.format_paths(nodes_of(spark, rows)).collect()
    assert [len(C.parse_turns(r["formatted"])) for r in out] == [n] and out[0]["score"] == 1.0
    assert all(t.count() <= 2 * n for ts in kept.values() for t in ts)  # not the 50 million rows of all paths
