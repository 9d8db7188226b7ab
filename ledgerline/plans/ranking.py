"""Global ordered numbering without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task,
and a ``partitionBy`` on a low-cardinality key (a quarter) moves each whole
group into one task. Both break at scale. The numbering here is built from
distributed steps only:

1. ``repartitionByRange`` on the full sort order plus a unique tiebreak, so a
   hot sort value (one bookings figure or ARR shared by a third of the rows) is
   split over several ranges; ``sortWithinPartitions``; and
   ``monotonically_increasing_id``, which after the sort encodes
   ``(partition, position)``.
2. ``checkpoint()`` into the shared checkpoint folder: the range bounds come
   from a sample, so the numbered frame is materialised once; recomputation
   after a lost executor reads the checkpoint instead of re-sampling.
3. Rows per range partition (one row per partition, so bounded by the
   partition count) -> running offsets -> broadcast -> global row number.

With ``live=True`` nothing runs while the plan is built, so a view of it shows the rows
that are there when it is queried: the ranges come from splitters that the query itself
finds (see ``_live_positions``) instead of a checkpointed sample. It reads its input
four times, so it is meant for views over pre-aggregated rows and for results that
must not be a snapshot; the default reads it once.

``rank`` is the place of the first peer (equal partition and order keys): one
window per range partition finds it inside the partition, and a
one-row-per-partition summary carries it across partition boundaries (see
``rank_within``); no join on the peer key, so a hot peer group stays split. ``ntile`` is a closed formula of the row number and the
total.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id: partition id in the upper 31 bits


@dataclass(frozen=True)
class Key:
    """One sort key: column name, direction and null placement (spelled out, T5/T6)."""

    name: str
    ascending: bool = True
    nulls_first: bool = False

    def order(self) -> Column:
        c = F.col(self.name)
        if self.ascending:
            return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()
        return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()


def asc(name: str, nulls_first: bool = False) -> Key:
    return Key(name, True, nulls_first)


def desc(name: str, nulls_first: bool = False) -> Key:
    return Key(name, False, nulls_first)


def _positions(df: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, with ``__pid`` / ``__pos``: partition and place in it (from 0)."""
    ensure_checkpoint_dir(df.sparkSession)
    orders = [k.order() for k in keys]
    ranged = (df.repartitionByRange(*orders)
                .sortWithinPartitions(*orders)
                .withColumn("__mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    return ranged.withColumns({"__pid": F.shiftright(F.col("__mid"), _POS_BITS),
                               "__pos": F.col("__mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))}).drop("__mid")


SAMPLED_KEYS = 20_000  # keys that the splitters of a live plan are chosen from, about


def _before(keys: Sequence[Key], a, b) -> Column:
    """Whether the key struct ``a`` comes before ``b``; fields k0, k1, ..."""
    out = F.lit(False)
    for i, k in reversed(list(enumerate(keys))):
        x, y = a[f"k{i}"], b[f"k{i}"]
        nulls = (x.isNull() & y.isNotNull()) if k.nulls_first else (x.isNotNull() & y.isNull())
        less = F.coalesce(x < y if k.ascending else x > y, F.lit(False)) | nulls
        out = less | (x.eqNullSafe(y) & out)
    return out


def _live_positions(df: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """``_positions`` without a job: the splitters are scalar subqueries of the plan.

    A key belongs to the sample if its hash is small enough for about ``SAMPLED_KEYS`` keys of all
    rows to be; the sample's quantiles are the splitters, as many as shuffle partitions, and a row's
    range is found by binary search. Hashes and quantiles depend on the rows only, so a
    recomputed task finds the same ranges. The sort keys should end with a unique one: then a
    hot value is spread over several ranges.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*[F.col(f"`{k.name}`").alias(f"k{i}") for i, k in enumerate(keys)])
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = (F.xxhash64(F.lit(29), *[f"`{k.name}`" for k in keys]).cast("double") / F.lit(2.0 ** 64) + 0.5) * rows
    ordered = F.array_sort(F.collect_set(key), lambda a, b: F.when(_before(keys, a, b), -1).when(_before(keys, b, a), 1).otherwise(0))
    chosen = df.where(share <= SAMPLED_KEYS).agg(ordered.alias("s"))
    at = lambda i: F.get(F.col("s"), F.floor(i * F.size("s") / parts).cast("int"))
    cuts = chosen.select(F.filter(F.transform(F.sequence(F.lit(1), F.lit(max(1, parts - 1))), at), lambda x: x.isNotNull()).alias("cuts")).scalar()
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(parts.bit_length()))])
    keyed = df.withColumns({"__key": key, "__cuts": cuts})
    c, own = F.col("__cuts"), F.col("__key")
    # the number of splitters before the row's key
    found = F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        (low + step <= F.size(c)) & _before(keys, F.get(c, low + step - 1), own), low + step).otherwise(low))
    placed = keyed.withColumn("__pid", found.cast("long")).drop("__key", "__cuts")
    inside = Window.partitionBy("__pid").orderBy(*[k.order() for k in keys]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn("__pos", F.count(F.lit(1)).over(inside) - 1)


def _parts():
    """Windows over one row per range partition (bounded by the partition count): in order, and all before a row."""
    order = Window.orderBy("__pid")
    return order, order.rowsBetween(Window.unboundedPreceding, -1)


def sequence(df: DataFrame, keys: Sequence[Key], out: str = "_rn", total: str | None = None, live: bool = False) -> DataFrame:
    """Add ``out``: 1-based global row number in the order ``keys`` (make it total
    with a unique tiebreak key). Optionally ``total``: the number of rows."""
    placed = _live_positions(df, keys) if live else _positions(df, keys)
    _, before = _parts()
    offsets = placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")).select(
        "__pid",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
        F.sum("__n").over(Window.partitionBy()).alias("__total"),
    )
    numbered = placed.join(F.broadcast(offsets), "__pid").withColumn(out, F.col("__off") + F.col("__pos") + 1)
    if total:
        numbered = numbered.withColumn(total, F.col("__total"))
    return numbered.drop("__off", "__total", "__pid", "__pos")


def _changed(names: Sequence[str], order: Window) -> Column:
    """Whether a row's values differ from those of the row before it (nulls are equal, as peers are in RANK)."""
    out = F.col("__pos") == 0
    for n in names:
        out = out | ~F.col(n).eqNullSafe(F.lag(n).over(order))
    return out


def rank_within(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Key],
                tiebreak: Sequence[Key], out: str = "rank", live: bool = False) -> DataFrame:
    """``RANK() OVER (PARTITION BY partition_by ORDER BY order_by)`` as INT.

    ``tiebreak`` (unique together with the other keys) only spreads peers over
    range partitions; it does not change any rank. The rank is the place of
    the first peer minus that of the first row of the partition group.

    One exchange by range partition serves everything: inside a partition a
    window in sorted order marks where the group and the peers change and
    carries the marks forward; a summary with one row per range partition
    (rows, first and last keys, last marks) tells whether a partition's first
    run continues the one before it, and where that run began. No join on the
    peer key, so a hot peer group never meets in one task.
    """
    place = _live_positions if live else _positions
    placed = place(df, [*(Key(p, True, True) for p in partition_by), *order_by, *tiebreak])
    order, before = _parts()
    runs = {"g": list(partition_by), "p": [*partition_by, *[k.name for k in order_by]]}
    inside = Window.partitionBy("__pid").orderBy("__pos")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = placed.withColumns({f"__new_{r}": _changed(names, inside) for r, names in runs.items()})
    local = marked.withColumns({
        f"__at_{r}": F.last(F.when(F.col(f"__new_{r}"), F.col("__pos")), ignorenulls=True).over(upto) for r in runs})
    keys = runs["p"]
    summary = local.groupBy("__pid").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.min_by(F.col(k), F.col("__pos")).alias(f"__f{i}") for i, k in enumerate(keys)],
        *[F.max_by(F.col(k), F.col("__pos")).alias(f"__l{i}") for i, k in enumerate(keys)],
        *[F.max(f"__at_{r}").alias(f"__last_{r}") for r in runs])
    summary = summary.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    for r, names in runs.items():
        goes_on = F.lag("__pid").over(order).isNotNull()
        for i in range(len(names)):
            goes_on = goes_on & F.col(f"__f{i}").eqNullSafe(F.lag(f"__l{i}").over(order))
        summary = summary.withColumn(f"__on_{r}", goes_on)
    carry = summary.select("__pid", "__off", *[
        # the run before began in the nearest earlier partition that is not one run from end to end
        F.when(F.col(f"__on_{r}"), F.last(F.when(~(F.col(f"__on_{r}") & (F.col(f"__last_{r}") == 0)), F.col("__off") + F.col(f"__last_{r}")),
                                          ignorenulls=True).over(before)).alias(f"__from_{r}") for r in runs])
    joined = local.join(F.broadcast(carry), "__pid")
    start = {r: F.when((F.col(f"__at_{r}") == 0) & F.col(f"__from_{r}").isNotNull(), F.col(f"__from_{r}"))
             .otherwise(F.col("__off") + F.col(f"__at_{r}")) for r in runs}
    return joined.withColumn(out, (start["p"] - start["g"] + 1).cast("int")) \
                 .drop("__pid", "__pos", "__off", *[f"__{x}_{r}" for r in runs for x in ("new", "at", "from")])


def ntile(df: DataFrame, k: int, order_by: Sequence[Key], out: str = "ntile", live: bool = False) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order_by)`` over all rows, as INT.

    ``order_by`` must be a total order (end it with a unique key): with ties
    the reference's bucket of a tied row is undefined, here it is fixed.
    ``n`` rows, ``q = n div k``, ``r = n mod k``: the first ``r`` tiles hold
    ``q + 1`` rows, the rest ``q``.
    """
    if k <= 0:
        raise ValueError("ntile needs k >= 1")
    seq = sequence(df, order_by, out="__rn", total="__n", live=live)
    rn, n = F.col("__rn"), F.col("__n")
    q = F.call_function("div", n, F.lit(k))
    r = F.pmod(n, F.lit(k))
    big = r * (q + 1)
    tile = F.when(rn <= big, F.call_function("div", rn - 1, q + 1) + 1) \
            .otherwise(r + F.call_function("div", rn - big - 1, F.greatest(q, F.lit(1))) + 1)
    return seq.withColumn(out, tile.cast("int")).drop("__rn", "__n")
