"""Subscription derivation from Won deals.

The reference draws outcomes with a sequential seeded generator, so each row's
outcome depends on the file order. Here the draw is a hash of ``(seed, key)``:
deterministic per opportunity, independent of partitioning and of row order,
computed inside the projection (no Python, no driver loop).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import add_months_clamped
from ledgerline.functions.ratios import cents, from_cents, money, pct_half_up, scaled_half_up
from ledgerline.plans.ranking import asc, sequence


@dataclass(frozen=True)
class Outcome:
    """A renewal outcome: its share of draws and its multiplier range in 1/10000."""

    name: str
    share: float
    low_bp: int
    high_bp: int


# Outcome split and multiplier ranges of the post-sale model
# (70% flat at 1.0, 15% expansion 1.10-1.40, 10% churn at 0, 5% contraction
# 0.60-0.90), seed 42 and a 12-month term.
OUTCOMES = (
    Outcome("Renewed Flat", 0.70, 10000, 10000),
    Outcome("Expansion", 0.15, 11000, 14000),
    Outcome("Churned", 0.10, 0, 0),
    Outcome("Contraction", 0.05, 6000, 9000),
)
SEED = 42
TERM_MONTHS = 12

_SPACE = 2 ** 32


def thresholds(outcomes: Sequence[Outcome] = OUTCOMES) -> list[int]:
    """Upper draw bound per outcome: cumulative share of 2^32, rounded up."""
    out, acc = [], 0.0
    for o in outcomes[:-1]:
        acc += o.share
        out.append(math.ceil(round(acc, 12) * _SPACE))
    return out


def _draw(seed, tag: str, key: Column) -> Column:
    """First 32 bits of md5('<seed><tag>|' || key) as a BIGINT in [0, 2^32)."""
    digest = F.md5(F.concat(F.lit(f"{seed}{tag}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def weighted_assignment(df: DataFrame, key: str, seed=SEED, outcomes: Sequence[Outcome] = OUTCOMES,
                        outcome_col: str = "renewal_outcome",
                        multiplier_col: str = "multiplier_bp") -> DataFrame:
    """Add an outcome and an integer multiplier (1/10000) per key."""
    u = _draw(seed, "", F.col(key))
    v = _draw(seed, "m", F.col(key))
    bounds = thresholds(outcomes)
    name, mult = None, None
    for i, o in enumerate(outcomes):
        width = o.high_bp - o.low_bp + 1
        m = F.lit(o.low_bp) if width == 1 else F.lit(o.low_bp) + F.pmod(v, F.lit(width))
        if i < len(bounds):
            cond = u < F.lit(bounds[i])
            name = F.when(cond, F.lit(o.name)) if name is None else name.when(cond, F.lit(o.name))
            mult = F.when(cond, m) if mult is None else mult.when(cond, m)
        else:
            name = name.otherwise(F.lit(o.name)) if name is not None else F.lit(o.name)
            mult = mult.otherwise(m) if mult is not None else m
    return df.withColumns({outcome_col: name, multiplier_col: mult.cast("int")})


def won_with_terms(pipeline: DataFrame) -> DataFrame:
    """Won rows that can become a subscription (close date and value present)."""
    return pipeline.filter((F.col("deal_stage") == "Won")
                           & F.col("close_date").isNotNull() & F.col("close_value").isNotNull())


def derive_subscriptions(pipeline: DataFrame, seed=SEED, outcomes: Sequence[Outcome] = OUTCOMES,
                         term_months: int = TERM_MONTHS) -> DataFrame:
    """G1: one subscription per complete Won deal.

    The raw product is kept (not cleaned). ``subscription_id`` derives from the
    unique opportunity key instead of the file position.
    """
    won = won_with_terms(pipeline)
    drawn = weighted_assignment(won, "opportunity_id", seed, outcomes)
    renewal_cents = scaled_half_up(cents("close_value") * F.col("multiplier_bp"), F.lit(10000), 1)
    return drawn.select(
        F.concat(F.lit("SUB-"), F.col("opportunity_id")).alias("subscription_id"),
        "opportunity_id", "account", "product", "sales_agent",
        F.col("close_date").alias("start_date"),
        add_months_clamped("close_date", term_months).alias("renewal_date"),
        F.col("close_value").cast("decimal(12,2)").alias("starting_arr"),
        "renewal_outcome",
        from_cents(renewal_cents).cast("decimal(12,2)").alias("renewal_arr"),
    )


def number_subscriptions(subs: DataFrame, order_by: Sequence[str] = ("opportunity_id",),
                         prefix: str = "SUB-", width: int = 5, live: bool = False) -> DataFrame:
    """Running ids ``SUB-00001`` ... in a fixed order. The reference
    numbers in file order: ``order_by`` the source place that ``files.read_csv(...,
    ordinal=...)`` adds gives the same ids; the default is the opportunity's key. The row
    number is distributed (no single-partition window); ``format_string``
    keeps every digit past ``width``, where ``lpad`` would cut them."""
    seq = sequence(subs, [asc(c) for c in order_by], out="__seq", live=live)
    return seq.withColumn("subscription_id", F.format_string(f"{prefix}%0{width}d", F.col("__seq"))) \
              .select(*([] if "subscription_id" in subs.columns else ["subscription_id"]), *subs.columns)


def assignment_table(pipeline: DataFrame, seed=SEED, outcomes: Sequence[Outcome] = OUTCOMES) -> DataFrame:
    """G2 as a table: opportunity_id, renewal_outcome, renewal_multiplier (4 dp)."""
    drawn = weighted_assignment(won_with_terms(pipeline).select("opportunity_id"), "opportunity_id",
                                seed, outcomes)
    return drawn.select("opportunity_id", "renewal_outcome",
                        (F.col("multiplier_bp").cast("decimal(10,0)") / F.lit(10000))
                        .cast("decimal(10,4)").alias("renewal_multiplier"))


def outcome_distribution(subs: DataFrame) -> DataFrame:
    """Count and share (1 dp) per outcome; null outcomes are left out, like value_counts."""
    counted = subs.filter(F.col("renewal_outcome").isNotNull()).groupBy("renewal_outcome") \
                  .agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the aggregate: one row per outcome label
    total = F.sum("n").over(Window.partitionBy())
    return counted.select("renewal_outcome", "n", pct_half_up(F.col("n"), total, 1).alias("share_pct")) \
                  .orderBy(F.desc("n"), F.asc("renewal_outcome"))


def retention_sanity(subs: DataFrame) -> DataFrame:
    """The generator's own check: totals, GRR, NRR and logo churn in one pass."""
    agg = subs.agg(
        cents(F.sum("starting_arr")).alias("_s"), cents(F.sum("renewal_arr")).alias("_r"),
        cents(F.sum(F.least("renewal_arr", "starting_arr"))).alias("_cap"),
        F.count_if(F.col("renewal_outcome") == "Churned").alias("_ch"), F.count(F.lit(1)).alias("_n"),
    )
    return agg.select(
        money(from_cents("_s")).alias("total_starting_arr"),
        money(from_cents("_r")).alias("total_renewal_arr"),
        pct_half_up("_cap", "_s", 1).alias("grr_pct"),
        pct_half_up("_r", "_s", 1).alias("nrr_pct"),
        pct_half_up("_ch", "_n", 1).alias("logo_churn_pct"),
    )


def dropped_incomplete_won(pipeline: DataFrame) -> DataFrame:
    """Won rows lacking close_date or close_value (not turned into subscriptions)."""
    won = F.col("deal_stage") == "Won"
    incomplete = won & (F.col("close_date").isNull() | F.col("close_value").isNull())
    return pipeline.agg(F.count(F.lit(1)).alias("total_opportunities"),
                        F.count_if(won).alias("won_opportunities"),
                        F.count_if(incomplete).alias("dropped_incomplete_won"))
