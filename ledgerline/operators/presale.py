"""Pre-sale pipeline metrics.

Conventions shared by every job: counts are BIGINT, money DECIMAL(38,2) summed
exactly, ratios DOUBLE rounded half away from zero from integer sums
(``ledgerline.functions.ratios``), and the null placement of every ORDER BY is
spelled out (Postgres puts nulls last ascending and first descending).
Joins to a dimension happen after the fact has been pre-aggregated to the
dimension's key, so the join and the final grouping see one row per key
instead of one row per deal; the partial sums are additive, so a duplicated
dimension row still fans out exactly like join-then-aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.cleaning import canonicalize_values, mapped
from ledgerline.functions.dates import day_diff, month_start, quarter_start
from ledgerline.functions.ratios import (avg_half_up, cents, from_cents, money, money_avg_half_up,
                                         pct_half_up, ratio_half_up, scaled_half_up)
from ledgerline.plans.joins import join_dimension
from ledgerline.plans.ranking import asc, desc, rank_within

OPEN_STAGES = ("Prospecting", "Engaging")
CLOSED_STAGES = ("Won", "Lost")
# Stage order of the snapshot and the forecast categories with
# their weights (Prospecting -> Pipeline 0.10, Engaging -> Commit 0.60).
STAGE_ORDER = {"Prospecting": 1, "Engaging": 2, "Won": 3, "Lost": 4}
FORECAST = {"Prospecting": ("Pipeline", Decimal("0.10")), "Engaging": ("Commit", Decimal("0.60"))}


def _stage():
    return F.col("deal_stage")


def _won():
    return _stage() == "Won"


def _lost():
    return _stage() == "Lost"


def _closed():
    return _stage().isin(*CLOSED_STAGES)


def _win_partials(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(_won()).alias("won"), F.count_if(_lost()).alias("lost"),
                               F.count_if(_closed()).alias("_closed"))


def _win_output(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    out = parts.select(*by, "won", "lost", pct_half_up("won", "_closed", 1).alias("win_rate_pct"))
    return out.orderBy(F.desc_nulls_first("win_rate_pct"), *[F.asc_nulls_last(c) for c in by])


def win_rate(pipeline: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """P1a-c: won, lost and Won/(Won+Lost) in percent, per group of raw values."""
    return _win_output(_win_partials(pipeline, list(by)), list(by))


def win_rate_by_team(pipeline: DataFrame, teams: DataFrame, level: str) -> DataFrame:
    """P1d/P1e: win rate per manager or regional office (inner join: unknown agents drop)."""
    per_agent = pipeline.filter(F.col("sales_agent").isNotNull()) \
                        .groupBy("sales_agent").agg(F.count_if(_won()).alias("w"), F.count_if(_lost()).alias("l"),
                                                    F.count_if(_closed()).alias("c"))
    joined = join_dimension(per_agent, teams.select("sales_agent", level), "sales_agent", how="inner")
    parts = joined.groupBy(level).agg(F.sum("w").alias("won"), F.sum("l").alias("lost"),
                                      F.sum("c").alias("_closed"))
    return _win_output(parts, [level])


def sales_cycle(pipeline: DataFrame, by: str) -> DataFrame:
    """Average close - engage days of Won deals (1 dp) and the Won count per group."""
    days = day_diff("close_date", "engage_date")
    agg = pipeline.filter(_won()).groupBy(by).agg(
        F.sum(days).alias("_d"), F.count(days).alias("_nd"), F.count(F.lit(1)).alias("won_deals"))
    return agg.select(by, avg_half_up("_d", "_nd", 1).alias("avg_cycle_days"), "won_deals") \
              .orderBy(F.asc_nulls_last("avg_cycle_days"), F.asc_nulls_last(by))


def pipeline_velocity(pipeline: DataFrame) -> DataFrame:
    """Open x win rate x average deal / average cycle, from one scan.

    The displayed inputs are exact (4, 2, 1 dp). The velocity uses unrounded
    inputs: exact sums, then doubles in one fixed order, then half-up to cents.
    """
    days = F.when(_won(), day_diff("close_date", "engage_date"))
    value = F.when(_won(), F.col("close_value"))
    a = pipeline.agg(
        F.count_if(_stage().isin(*OPEN_STAGES)).alias("open_count"),
        F.count_if(_won()).alias("_won"), F.count_if(_closed()).alias("_closed"),
        cents(F.sum(value)).alias("_vc"), F.count(value).alias("_nv"),
        F.sum(days).alias("_d"), F.count(days).alias("_nd"),
    )
    dbl = lambda c: F.col(c).cast("double")
    rate = F.when(F.col("_closed") != 0, dbl("_won") / dbl("_closed"))
    avg_value = F.when(F.col("_nv") != 0, dbl("_vc") / F.lit(100.0) / dbl("_nv"))
    avg_days = F.when(F.col("_nd") != 0, dbl("_d") / dbl("_nd"))
    v = dbl("open_count") * rate * avg_value / F.when(avg_days != 0, avg_days)
    v_rounded = F.signum(v) * F.floor(F.abs(v) * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)
    return a.select(
        "open_count",
        ratio_half_up("_won", "_closed", 4).alias("win_rate"),
        money_avg_half_up("_vc", "_nv").alias("avg_deal_size"),
        avg_half_up("_d", "_nd", 1).alias("avg_cycle_days"),
        v_rounded.alias("pipeline_velocity_per_day"),
    )


def stage_snapshot(pipeline: DataFrame, stage_order: Mapping[str, int] = STAGE_ORDER) -> DataFrame:
    """Deals and value per stage, each stage as a percentage of the previous one.

    The window runs over the per-stage aggregate (one row per stage label).
    Unknown stages get a null order and sort last, by name among themselves.
    """
    agg = pipeline.groupBy("deal_stage").agg(F.count(F.lit(1)).alias("deal_count"),
                                             F.sum("close_value").alias("_tv"))
    agg = agg.withColumn("_ord", mapped("deal_stage", dict(stage_order), keep_unmapped=False).cast("int"))
    w = Window.orderBy(F.asc_nulls_last("_ord"), F.asc_nulls_last("deal_stage"))
    prev = F.lag("deal_count").over(w)
    return agg.select("deal_stage", "deal_count", money("_tv").alias("total_value"),
                      pct_half_up(F.col("deal_count"), prev, 1).alias("pct_of_previous_stage"), "_ord") \
              .orderBy(F.asc_nulls_last("_ord"), F.asc_nulls_last("deal_stage")).drop("_ord")


def engaging_branch_rates(pipeline: DataFrame) -> DataFrame:
    """Won and Lost as a share of current Engaging deals (a snapshot ratio, may exceed 100)."""
    a = pipeline.agg(F.count_if(_stage() == "Engaging").alias("engaging_count"),
                     F.count_if(_won()).alias("won_count"), F.count_if(_lost()).alias("lost_count"))
    return a.select("engaging_count", "won_count", "lost_count",
                    pct_half_up("won_count", "engaging_count", 1).alias("won_pct_of_engaging"),
                    pct_half_up("lost_count", "engaging_count", 1).alias("lost_pct_of_engaging"))


def _deal_size_output(parts: DataFrame, by: str) -> DataFrame:
    return parts.select(by, money_avg_half_up("_vc", "_nv").alias("avg_deal_size"), "won_deals") \
                .orderBy(F.desc_nulls_first("avg_deal_size"), F.asc_nulls_last(by))


def deal_size_by_product(pipeline: DataFrame) -> DataFrame:
    """Average Won deal value (2 dp) per raw product."""
    parts = pipeline.filter(_won()).groupBy("product").agg(
        cents(F.sum("close_value")).alias("_vc"), F.count("close_value").alias("_nv"), F.count(F.lit(1)).alias("won_deals"))
    return _deal_size_output(parts, "product")


def deal_size_by_sector(pipeline: DataFrame, accounts: DataFrame) -> DataFrame:
    """Average Won deal value per raw sector (inner join: deals without account drop)."""
    per_account = pipeline.filter(_won() & F.col("account").isNotNull()).groupBy("account").agg(
        cents(F.sum("close_value")).alias("_vc"), F.count("close_value").alias("_nv"), F.count(F.lit(1)).alias("_n"))
    joined = join_dimension(per_account, accounts.select("account", "sector"), "account", how="inner")
    parts = joined.groupBy("sector").agg(F.sum("_vc").alias("_vc"), F.sum("_nv").alias("_nv"),
                                         F.sum("_n").alias("won_deals"))
    return _deal_size_output(parts, "sector")


def monthly_bookings(pipeline: DataFrame) -> DataFrame:
    """Won deals and bookings per close month (no calendar fill)."""
    agg = pipeline.filter(_won()).groupBy(month_start("close_date").alias("month")).agg(
        F.count(F.lit(1)).alias("deals_won"), F.sum("close_value").alias("_b"))
    return agg.select("month", "deals_won", money("_b").alias("total_bookings")) \
              .orderBy(F.asc_nulls_last("month"))


def agent_quarter_rank(pipeline: DataFrame, live: bool = False) -> DataFrame:
    """Bookings per agent and quarter with RANK() per quarter, bookings descending,
    nulls first (Postgres default). Ranked without a per-quarter single task; ``live``
    as in ``plans.ranking``."""
    agg = pipeline.filter(_won()).groupBy(quarter_start("close_date").alias("quarter"), "sales_agent").agg(
        F.count(F.lit(1)).alias("deals_closed"), F.sum("close_value").alias("bookings"))
    agg = agg.withColumn("bookings", money("bookings"))
    ranked = rank_within(agg, ["quarter"], [desc("bookings", nulls_first=True)],
                         [asc("sales_agent", nulls_first=True)], out="rank_in_quarter", live=live)
    return ranked.select("quarter", "sales_agent", "deals_closed", "bookings", "rank_in_quarter") \
                 .orderBy(F.asc_nulls_last("quarter"), "rank_in_quarter", F.asc_nulls_last("sales_agent"))


def weighted_forecast(pipeline: DataFrame, products: DataFrame, product_fixes: Mapping[str, str],
                      forecast: Mapping[str, tuple[str, Decimal]] = FORECAST) -> DataFrame:
    """Open deals per stage valued at close value or list price, weighted.

    Products are cleaned first and joined inner, so deals whose product stays
    unknown drop out (as in the reference). Weights are DECIMAL; the weighted
    value is rounded half up to cents.
    """
    open_deals = canonicalize_values(pipeline.filter(_stage().isin(*OPEN_STAGES)), {"product": product_fixes})
    per_product = open_deals.groupBy("deal_stage", "product").agg(
        F.count(F.lit(1)).alias("_n"), cents(F.sum("close_value")).alias("_vc"),
        F.count("close_value").alias("_nv"))
    joined = join_dimension(per_product, products.select("product", "sales_price"), "product", how="inner")
    # sum(coalesce(close_value, price)) = sum(close_value) + price x (rows without close_value)
    est_cents = (F.coalesce(F.col("_vc"), F.lit(0))
                 + F.coalesce(cents("sales_price") * (F.col("_n") - F.col("_nv")), F.lit(0)))
    est_cents = F.when((F.col("_nv") > 0) | F.col("sales_price").isNotNull(), est_cents)
    by_stage = joined.groupBy("deal_stage").agg(F.sum("_n").alias("open_deal_count"),
                                                F.sum(est_cents).alias("_est"))
    category = mapped("deal_stage", {k: v[0] for k, v in forecast.items()}, keep_unmapped=False)
    # weights keep their own scale; the product is rounded once
    digits = max([2, *(-Decimal(w).normalize().as_tuple().exponent for _, w in forecast.values())])
    units = mapped("deal_stage", {k: int(Decimal(w) * 10 ** digits) for k, (_, w) in forecast.items()}, keep_unmapped=False)
    weight = mapped("deal_stage", {k: Decimal(w) for k, (_, w) in forecast.items()}, keep_unmapped=False)
    return by_stage.select(
        "deal_stage",
        category.alias("forecast_category"),
        weight.cast(f"decimal(38,{digits})").alias("category_weight"),
        "open_deal_count",
        from_cents("_est").alias("estimated_value"),
        from_cents(scaled_half_up(F.col("_est") * units, F.lit(10 ** digits), 1)).alias("weighted_pipeline"),
    ).orderBy(F.asc_nulls_last("deal_stage"))
