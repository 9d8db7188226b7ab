"""Post-sale subscription metrics.

Money is summed in integer cents, so GRR / NRR are exact ratios of sums.
``renewal_outcome`` drives churn and expansion (a null outcome is neither
churned nor renewed: ``!=`` drops it, as three-valued logic does in SQL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.ratios import cents, from_cents, money, pct_half_up
from ledgerline.plans.joins import join_dimension
from ledgerline.plans.ranking import asc, ntile


def _outcome():
    return F.col("renewal_outcome")


def _churned():
    return _outcome() == "Churned"


def _expanded():
    return _outcome() == "Expansion"


def _renewed():
    return _outcome() != "Churned"


def grr_nrr(subs: DataFrame) -> DataFrame:
    """Total starting and renewal ARR, GRR (each row capped at its start) and NRR."""
    a = subs.agg(cents(F.sum("starting_arr")).alias("_s"), cents(F.sum("renewal_arr")).alias("_r"),
                 cents(F.sum(F.least("renewal_arr", "starting_arr"))).alias("_cap"))
    return a.select(from_cents("_s").alias("total_starting_arr"), from_cents("_r").alias("total_renewal_arr"),
                    pct_half_up("_cap", "_s", 1).alias("grr_pct"), pct_half_up("_r", "_s", 1).alias("nrr_pct"))


def logo_churn(subs: DataFrame) -> DataFrame:
    """R2: churned subscriptions over all subscriptions (not distinct accounts)."""
    a = subs.agg(F.count_if(_churned()).alias("churned_count"), F.count(F.lit(1)).alias("total_subscriptions"))
    return a.select("churned_count", "total_subscriptions",
                    pct_half_up("churned_count", "total_subscriptions", 1).alias("logo_churn_pct"))


def expansion_rate(subs: DataFrame) -> DataFrame:
    """Expanded over renewed (flat, expanded or contracted)."""
    a = subs.agg(F.count_if(_expanded()).alias("expanded_count"), F.count_if(_renewed()).alias("renewed_count"))
    return a.select("expanded_count", "renewed_count",
                    pct_half_up("expanded_count", "renewed_count", 1).alias("expansion_rate_pct"))


def expansion_arr_by_product(subs: DataFrame) -> DataFrame:
    """Expanded subscriptions and the ARR added, per raw product."""
    a = subs.filter(_expanded()).groupBy("product").agg(
        F.count(F.lit(1)).alias("expanded_accounts"),
        cents(F.sum(F.col("renewal_arr") - F.col("starting_arr"))).alias("_x"))
    return a.select("product", "expanded_accounts", from_cents("_x").alias("expansion_arr_generated")) \
            .orderBy(F.desc_nulls_first("expansion_arr_generated"), F.asc_nulls_last("product"))


def _churn_output(parts: DataFrame, key: str, total_name: str) -> DataFrame:
    return parts.select(key, "churned", F.col("_n").alias(total_name),
                        pct_half_up("churned", "_n", 1).alias("churn_rate_pct"))


def churn_by_sector(subs: DataFrame, accounts: DataFrame) -> DataFrame:
    """Churn rate per raw sector (inner join to accounts)."""
    per_account = subs.filter(F.col("account").isNotNull()).groupBy("account").agg(
        F.count_if(_churned()).alias("_c"), F.count(F.lit(1)).alias("_m"))
    joined = join_dimension(per_account, accounts.select("account", "sector"), "account", how="inner")
    parts = joined.groupBy("sector").agg(F.sum("_c").alias("churned"), F.sum("_m").alias("_n"))
    return _churn_output(parts, "sector", "total") \
        .orderBy(F.desc_nulls_first("churn_rate_pct"), F.asc_nulls_last("sector"))


def churn_by_size_quartile(subs: DataFrame, tiles: int = 4, live: bool = False) -> DataFrame:
    """NTILE(tiles) by starting ARR over all subscriptions, churn per tile.

    Ties in starting ARR are split by subscription_id (the reference leaves
    them undefined). The tile is computed without a single-partition window; ``live``
    as in ``plans.ranking``.
    """
    sized = ntile(subs.select("subscription_id", "starting_arr", "renewal_outcome"), tiles,
                  [asc("starting_arr"), asc("subscription_id")], out="size_quartile", live=live)
    parts = sized.groupBy("size_quartile").agg(
        money(F.min("starting_arr")).alias("min_arr_in_quartile"),
        money(F.max("starting_arr")).alias("max_arr_in_quartile"),
        F.count_if(_churned()).alias("churned"), F.count(F.lit(1)).alias("_n"))
    return parts.select("size_quartile", "min_arr_in_quartile", "max_arr_in_quartile", "churned",
                        F.col("_n").alias("total"), pct_half_up("churned", "_n", 1).alias("churn_rate_pct")) \
                .orderBy("size_quartile")


def churn_by_agent_top(subs: DataFrame, n: int = 15) -> DataFrame:
    """The n agents with the most subscriptions and their churn rate
    (ties broken by agent name, nulls last). A distributed top-k, no full sort."""
    parts = subs.groupBy("sales_agent").agg(F.count_if(_churned()).alias("churned"),
                                            F.count(F.lit(1)).alias("_n"))
    return _churn_output(parts, "sales_agent", "total_subscriptions") \
        .orderBy(F.desc("total_subscriptions"), F.asc_nulls_last("sales_agent")).limit(n)
