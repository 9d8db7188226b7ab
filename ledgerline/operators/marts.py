"""The three published marts and their verification queries (M1-M6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.cleaning import canonicalize_values, mapped
from ledgerline.functions.dates import day_diff
from ledgerline.functions.ratios import avg_half_up, cents, from_cents, pct_half_up
from ledgerline.plans.joins import join_dimension
from ledgerline.plans.ranking import asc, desc, rank_within

# Forecast category of every stage in the summary mart, and the
# label of the retention mart's total row.
FORECAST_CATEGORY = {"Prospecting": "Pipeline", "Engaging": "Commit", "Won": "Closed", "Lost": "Omitted"}
TOTAL_LABEL = "ALL PRODUCTS"

def pipeline_summary(pipeline: DataFrame, products: DataFrame, teams: DataFrame, accounts: DataFrame,
                     product_fixes: Mapping[str, str], sector_fixes: Mapping[str, str],
                     location_fixes: Mapping[str, str]) -> DataFrame:
    """M1: one row per opportunity, cleaned and enriched by three left joins.

    Row count equals the pipeline's as long as the dimension keys are unique
    (check with ``duplicate_keys``). Null account / agent keys are spread over
    the reducers of a shuffled join (``join_dimension``).
    """
    fact = canonicalize_values(pipeline, {"product": product_fixes})
    fact = join_dimension(fact, products.select("product", "sales_price"), "product",
                          how="left", spread_col="opportunity_id")
    fact = join_dimension(fact, teams.select("sales_agent", "manager", "regional_office"), "sales_agent",
                          how="left", spread_col="opportunity_id")
    acc = accounts.select("account", mapped("sector", sector_fixes).alias("sector"),
                          mapped("office_location", location_fixes).alias("office_location"),
                          F.col("revenue").alias("account_revenue_millions"),
                          F.col("employees").alias("account_employees"))
    fact = join_dimension(fact, acc, "account", how="left", spread_col="opportunity_id")
    return fact.select(
        "opportunity_id", "account", "product", "deal_stage",
        mapped("deal_stage", FORECAST_CATEGORY, keep_unmapped=False).alias("forecast_category"),
        "engage_date", "close_date", "close_value",
        F.coalesce("close_value", "sales_price").alias("estimated_value"),
        day_diff("close_date", "engage_date").alias("sales_cycle_days"),
        "sales_agent", "manager", "regional_office", "sector", "office_location",
        "account_revenue_millions", "account_employees",
    )


def agent_scorecard(pipeline: DataFrame, teams: DataFrame, live: bool = False) -> DataFrame:
    """M2: one row per agent present in the pipeline, with a bookings rank.

    Deals are pre-aggregated per agent, then joined to the team table and
    re-grouped by (agent, manager, office) with additive sums, which equals
    grouping the joined deals. RANK is descending with nulls last and runs
    without a single-partition window. With ``live`` no job runs before the result is
    asked for (see ``plans.ranking``), as a view needs it.
    """
    won = F.col("deal_stage") == "Won"
    days = F.when(won, day_diff("close_date", "engage_date"))
    per_agent = pipeline.groupBy("sales_agent").agg(
        F.count_if(won).alias("_w"), F.count_if(F.col("deal_stage") == "Lost").alias("_l"),
        F.count_if(F.col("deal_stage").isin("Won", "Lost")).alias("_c"),
        F.sum(days).alias("_d"), F.count(days).alias("_nd"),
        cents(F.sum(F.when(won, F.col("close_value")))).alias("_b"))
    joined = join_dimension(per_agent, teams.select("sales_agent", "manager", "regional_office"),
                            "sales_agent", how="left")
    grouped = joined.groupBy("sales_agent", "manager", "regional_office").agg(
        F.sum("_w").alias("won_deals"), F.sum("_l").alias("lost_deals"), F.sum("_c").alias("_c"),
        F.sum("_d").alias("_d"), F.sum("_nd").alias("_nd"), F.sum("_b").alias("_b"))
    card = grouped.select(
        "sales_agent", "manager", "regional_office", "won_deals", "lost_deals",
        pct_half_up("won_deals", "_c", 1).alias("win_rate_pct"),
        avg_half_up("_d", "_nd", 1).alias("avg_cycle_days"),
        from_cents("_b").alias("total_bookings"))
    ranked = rank_within(card, [], [desc("total_bookings", nulls_first=False)],
                         [asc("sales_agent", nulls_first=True), asc("manager", nulls_first=True),
                          asc("regional_office", nulls_first=True)], out="bookings_rank", live=live)
    return ranked.select("sales_agent", "manager", "regional_office", "won_deals", "lost_deals",
                         "win_rate_pct", "avg_cycle_days", "total_bookings", "bookings_rank") \
                 .orderBy("bookings_rank", F.asc_nulls_last("sales_agent"))


def _retention_partials(subs: DataFrame, product_fixes: Mapping[str, str]) -> DataFrame:
    s, r = F.col("starting_arr"), F.col("renewal_arr")
    out = F.col("renewal_outcome")
    return subs.groupBy(mapped("product", product_fixes).alias("product")).agg(
        F.count(F.lit(1)).alias("_n"), cents(F.sum(s)).alias("_s"), cents(F.sum(r)).alias("_r"),
        cents(F.sum(F.least(r, s))).alias("_cap"), F.count_if(out == "Churned").alias("_ch"),
        F.count_if(out == "Expansion").alias("_ex"), F.count_if(out != "Churned").alias("_rn"))


def _retention_rows(parts: DataFrame, product_col) -> DataFrame:
    return parts.select(
        product_col.alias("product"),
        F.col("_n").alias("total_subscriptions"),
        from_cents("_s").alias("total_starting_arr"),
        from_cents("_r").alias("total_renewal_arr"),
        pct_half_up("_cap", "_s", 1).alias("grr_pct"),
        pct_half_up("_r", "_s", 1).alias("nrr_pct"),
        F.col("_ch").alias("churned_count"),
        pct_half_up("_ch", "_n", 1).alias("logo_churn_pct"),
        F.col("_ex").alias("expanded_count"),
        pct_half_up("_ex", "_rn", 1).alias("expansion_rate_pct"),
    )


def retention_summary(subs: DataFrame, product_fixes: Mapping[str, str]) -> DataFrame:
    """M3: retention per cleaned product plus an 'ALL PRODUCTS' total row.

    One scan: the per-product partials (counts and cent sums, all additive)
    feed both the detail rows and the total, which re-aggregates the small
    partials instead of rescanning. The global aggregate keeps the total row
    on empty input (count 0, the rest null), and a genuine null product or a
    product literally named 'ALL PRODUCTS' stays a separate detail row.
    """
    parts = _retention_partials(subs, product_fixes)
    detail = _retention_rows(parts, F.col("product"))
    total = parts.agg(*[F.sum(c).alias(c) for c in ("_s", "_r", "_cap")],
                      *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_n", "_ch", "_ex", "_rn")])
    total_row = _retention_rows(total, F.lit(TOTAL_LABEL))
    return detail.unionByName(total_row)


def summary_row_count(summary: DataFrame) -> DataFrame:
    """M4: rows of the summary mart (must equal the pipeline's)."""
    return summary.agg(F.count(F.lit(1)).alias("row_count"))


def distinct_products(summary: DataFrame) -> DataFrame:
    """M5: distinct cleaned products in the summary mart."""
    return summary.select("product").distinct().orderBy(F.asc_nulls_last("product"))


def retention_headline(retention: DataFrame) -> DataFrame:
    """M6: the total row of the retention mart."""
    return retention.filter(F.col("product") == TOTAL_LABEL)
