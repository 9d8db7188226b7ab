"""Chat formatting over reply trees.

Messages form trees (node, parent). Root-to-leaf paths are enumerated by
iterative self-joins with doubling: after round k every node is joined to its
ancestor at distance 2^k and carries the sum of the scores up to there, so the
longest chain of n messages takes log2(n) rounds of one row a node. A leaf's score is the
mean of its path's message scores; the best ``per_tree`` leaves of a tree are
kept (ties: longer path, then smaller leaf). Only their paths are listed, from
the same tables (a leaf, its ancestor at distance 1, those of both at distance
2, ...): rows add up to the lengths of the chosen paths, whatever the number of
branches, and no path is carried as a growing array. Each chosen path is formatted as one
conversation.

Template: a turn is ``[INST] text [/INST]`` for user, ``text</s>`` behind
``[OUT] `` for assistant, and ``[TURN role] text [/TURN]`` for every other
role. Control strings inside texts and roles are escaped reversibly: a
backslash is doubled, and one backslash is put behind the first character of a
control string. The loss mask is the list of (begin, length) in code points of
the assistant texts as they stand in the formatted string.

Linear conversations become trees by ``linear_nodes``: each row's parent is the
row before it by turn. One conversation is one output string, so the rows of a
conversation meet in one task when it is formatted.

Defined cases: a null text or role is empty; rows that repeat a turn follow
each other by role and text; a message whose parent is missing is a root; a
cycle, with or without replies to it, raises an error after log2 of the largest
tree's messages, plus one, rounds; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import stored

# fixed values: what marks turns; any of these strings inside a text is escaped
OPENERS = {"user": "[INST] ", "assistant": "[OUT] "}
CLOSERS = {"user": " [/INST]", "assistant": "</s>"}
_CONTROL = re.compile(r"([\[<])(?=/?INST\]|OUT\]|/?TURN|/?s>)")
_MAX_ROUNDS = 40


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """Undo ``escape``: a doubled backslash is one, a single one goes."""
    return re.sub(r"\\(\\?)", r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and its loss mask."""
    out, mask, at = [], [], 0
    for role, text in turns:
        body = escape(text)
        if role in OPENERS:
            head, tail = OPENERS[role], CLOSERS[role]
        else:
            head, tail = f"[TURN {escape(role).replace(']', chr(92) + ']')}] ", " [/TURN]"
        if role == "assistant":
            mask.append((at + len(head), len(body)))
        out += [head, body, tail]
        at += len(head) + len(body) + len(tail)
    return "".join(out), mask


_HEAD = re.compile(r"\[(?:(INST)|(OUT)|TURN ((?:[^\\\]]|\\.)*))\] ", re.S)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Read the turns back from a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _HEAD.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn begins at character {at}")
        role = "user" if m[1] else "assistant" if m[2] else unescape(m[3].replace("\\]", "]"))
        tail = CLOSERS.get(role, " [/TURN]")
        end = formatted.index(tail, m.end())  # a control string inside the text is broken by its escape
        turns.append((role, unescape(formatted[m.end():end])))
        at = end + len(tail)
    return turns


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """(tree, node, parent, role, text, score) of rows ordered by turn inside conv_id."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn"), F.col("role"), F.col("text"))
    rows = conversations.select("conv_id", F.row_number().over(order).cast("long").alias("k"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.select(F.col("conv_id").alias("tree"), F.col("k").alias("node"), F.when(F.col("k") > 1, F.col("k") - 1).alias("parent"),
                       "role", "text", F.lit(0.0).alias("score"))


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Tables (g, node, to, total, n): round k has each node's ancestor at distance 2^k, null above the root, and the sum
    of scores and number of messages from the node to below that ancestor; the last one is the whole way to the root.

    ``g`` is the tree as text, so that a null tree joins itself.
    """
    link = nodes.select(F.to_json(F.struct("tree")).alias("g"), "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("total"), F.lit(1).cast("long").alias("n"))
    largest = link.groupBy("g").count().agg(F.max("count")).head()[0] or 0
    known = link.select("g", F.col("node").alias("parent"), F.lit(True).alias("there"))
    met = link.join(known, ["g", "parent"], "left").select("g", "node", F.when(F.col("there"), F.col("parent")).alias("to"), "total", "n")
    tables = [stored(met, "jump")]
    for _ in range(min(_MAX_ROUNDS, max(1, largest).bit_length() + 1)):
        last = tables[-1]
        under = last.where("to is not null")
        if not under.head(1):
            return tables
        onward = last.select("g", F.col("node").alias("to"), F.col("to").alias("next"), F.col("total").alias("more"), F.col("n").alias("further"))
        moved = under.join(onward, ["g", "to"]).select("g", "node", F.col("next").alias("to"), (F.col("total") + F.col("more")).alias("total"), (F.col("n") + F.col("further")).alias("n"))
        tables.append(stored(last.where("to is null").unionByName(moved), "jump"))
    raise ValueError("a reply chain is a cycle")


def _leaves(tables: list[DataFrame]) -> DataFrame:
    """(g, node, total, n) of the nodes without replies, over their whole paths."""
    return tables[-1].join(tables[0].select("g", F.col("to").alias("node")), ["g", "node"], "left_anti").select("g", "node", "total", "n")


def _listed(tables: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """(g, leaf, node, up) of the paths of ``leaves`` (g, leaf)."""
    found = leaves.select("g", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up"))
    for k, table in enumerate(tables[:-1]):
        jump = table.where("to is not null").select("g", "node", "to")
        more = found.join(jump, ["g", "node"]).select("g", "leaf", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        found = stored(found.unionByName(more), "paths")
    return found


def paths(nodes: DataFrame) -> DataFrame:
    """(g, leaf, node, up): every node of every root-to-leaf path; ``up`` is its distance from the leaf.

    ``nodes`` needs tree, node, parent and score; node is unique inside its tree. Null trees are one tree.
    """
    tables = _climb(nodes)
    return _listed(tables, _leaves(tables).select("g", F.col("node").alias("leaf")))


def best_paths(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, g, leaf, rank, score, up, role, text): the turns of the best paths of every tree, place counted from the leaf."""
    body = nodes.select(F.to_json(F.struct("tree")).alias("g"), "tree", "node", "role", "text")
    tables = _climb(nodes)
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("mean"), F.desc("n"), "leaf"))
    leaves = _leaves(tables).select("g", F.col("node").alias("leaf"), (F.col("total") / F.col("n")).alias("mean"), "n")
    chosen = stored(leaves.withColumn("rank", rank).where(F.col("rank") <= per_tree).select("g", "leaf", "rank", "mean"), "chosen")
    return _listed(tables, chosen).join(chosen, ["g", "leaf"]).join(body, ["g", "node"]) \
        .select("tree", "g", "leaf", "rank", F.col("mean").alias("score"), "up", "role", "text")


CONVERSATION = "formatted string, mask array<struct<begin:long,length:long>>"
_MASK = pa.list_(pa.struct([("begin", pa.int64()), ("length", pa.int64())]))


def format_paths(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, rank, score, formatted, mask): one row per chosen path."""
    turns = best_paths(nodes, per_tree).groupBy("g", "leaf").agg(
        F.first("tree").alias("tree"), F.first("rank").alias("rank"), F.first("score").alias("score"),
        F.collect_list(F.struct((-F.col("up")).alias("place"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("turns"))
    ordered = turns.select("tree", "rank", "score", F.array_sort("turns").alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                done = [format_turns([(t["role"], t["text"]) for t in x]) for x in part.column(3).to_pylist()]
                masks = [[{"begin": b, "length": n} for b, n in m] for _, m in done]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([f for f, _ in done], pa.string()), pa.array(masks, _MASK)],
                                                 ["tree", "rank", "score", "formatted", "mask"])

    kind = ordered.schema["tree"].dataType.simpleString()
    return ordered.mapInArrow(run, f"tree {kind}, rank int, score double, {CONVERSATION}")


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns plus counts and digests taken from ``formatted`` and ``mask`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, mask in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                turns = parse_turns(text)
                every = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescape(text[m["begin"]:m["begin"] + m["length"]]) for m in mask)
                sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((len(turns), sha(every), len(loss), sha(loss), len(text)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             [*keep, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    fields = ", ".join(f"`{c}` {formatted.schema[c].dataType.simpleString()}" for c in keep)
    return formatted.select(F.col("formatted").alias("__formatted"), F.col("mask").alias("__mask"), *keep).mapInArrow(run, f"{fields}, {DIGEST}")
