"""Data-quality checks (V1-V9), written generically over table, key and column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.ratios import pct_half_up

# The match-status labels of the product check.
NOT_IN_PRODUCTS = "NOT IN products table"
IN_PRODUCTS = "matches products table"


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V1 / L2: one row per table (table_name, row_count), by name."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


def orphans_by_stage(pipeline: DataFrame, key: str = "account") -> DataFrame:
    """Rows without an account, per stage."""
    return pipeline.filter(F.col(key).isNull()).groupBy("deal_stage") \
                   .agg(F.count(F.lit(1)).alias("orphan_opportunities")) \
                   .select("orphan_opportunities", "deal_stage") \
                   .orderBy(F.desc("orphan_opportunities"), F.asc_nulls_last("deal_stage"))


def closed_orphans(pipeline: DataFrame, key: str = "account", stages: Sequence[str] = ("Won", "Lost")) -> DataFrame:
    """Closed deals without an account (expected empty)."""
    return pipeline.filter(F.col(key).isNull() & F.col("deal_stage").isin(*stages))


def unmatched_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """V3: distinct non-null fact keys absent from the dimension (anti-join)."""
    dim_key = dim_key or fact_key
    keys = fact.select(fact_key).filter(F.col(fact_key).isNotNull()).distinct()
    d = dim.select(F.col(dim_key).alias("__dk")).filter(F.col("__dk").isNotNull())
    return keys.join(d, keys[fact_key] == d["__dk"], "left_anti").orderBy(fact_key)


def product_match_status(pipeline: DataFrame, products: DataFrame) -> DataFrame:
    """V4: rows per raw product name and whether the name exists in ``products``.

    Grouping by the pipeline name and the matched dimension key, as in the
    reference; a null product counts as not in the table.
    """
    per_name = pipeline.groupBy("product").agg(F.count(F.lit(1)).alias("_n"))
    dim = products.select(F.col("product").alias("__p"))
    joined = per_name.join(dim, per_name["product"] == dim["__p"], "left")
    status = F.when(F.col("__p").isNull(), F.lit(NOT_IN_PRODUCTS)).otherwise(F.lit(IN_PRODUCTS))
    grouped = joined.groupBy(F.col("product").alias("pipeline_product_name"), F.col("__p")) \
                    .agg(F.sum("_n").alias("row_count"))
    return grouped.select("pipeline_product_name", "row_count", status.alias("match_status")) \
                  .orderBy(F.desc("row_count"), F.asc_nulls_last("pipeline_product_name"))


def null_audit_by_stage(pipeline: DataFrame) -> DataFrame:
    """V5: nulls of engage_date, close_date and close_value per stage."""
    a = pipeline.groupBy("deal_stage").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("engage_date").isNull()).alias("null_engage_date"),
        F.count_if(F.col("close_date").isNull()).alias("null_close_date"),
        F.count_if(F.col("close_value").isNull()).alias("null_close_value"))
    return a.select("deal_stage", "total_rows", "null_engage_date", "null_close_date", "null_close_value",
                    pct_half_up("null_close_date", "total_rows", 1).alias("pct_null_close_date")) \
            .orderBy(F.asc_nulls_last("deal_stage"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V6: key values occurring more than once (composite keys allowed)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def near_duplicate_names(df: DataFrame, col: str) -> DataFrame:
    """V7: names equal after lower(trim()), with their distinct spellings in sorted order.

    A spelling that occurs k > 1 times is listed once, as ``spelling xk``, so a
    name repeated millions of times costs one row and one entry. Null names
    form one group (variants null). ``name_spellings`` has the same facts as
    rows, for names with very many spellings.
    """
    piece = F.when(F.col("occurrences") > 1, F.concat("spelling", F.lit(" x"), F.col("occurrences").cast("string"))) \
             .otherwise(F.col("spelling")).alias("__piece")
    grouped = name_spellings(df, col).select("normalized_name", "spelling", "occurrences", piece) \
        .groupBy("normalized_name").agg(
            F.sum("occurrences").alias("occurrences"),
            F.expr("listagg(__piece, ', ') WITHIN GROUP (ORDER BY spelling)").alias("variants"))
    return grouped.filter(F.col("occurrences") > 1)


def name_spellings(df: DataFrame, col: str) -> DataFrame:
    """V7 as rows: (normalized_name, spelling, occurrences), counted map-side first."""
    return df.groupBy(F.lower(F.trim(F.col(col))).alias("normalized_name"), F.col(col).alias("spelling")) \
             .agg(F.count(F.lit(1)).alias("occurrences"))


def values_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """V8: rows per value matching a case-insensitive LIKE pattern."""
    return df.filter(F.col(col).ilike(pattern)).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def untraceable_subscriptions(subs: DataFrame, pipeline: DataFrame) -> DataFrame:
    """V9: subscriptions without a Won opportunity. The stage test belongs to the
    join's right side (filter, then anti-join): moving it after the join would
    report nothing. A null opportunity_id is reported."""
    won = pipeline.filter(F.col("deal_stage") == "Won").select(
        F.lit(False).alias("__nk"), F.col("opportunity_id").cast("string").alias("__jk"))
    # A null key can never match, so such rows are always reported; the second
    # key column spreads them over reducers instead of hashing all to one.
    keyed = subs.withColumns({
        "__nk": F.col("opportunity_id").isNull(),
        "__jk": F.coalesce(F.col("opportunity_id").cast("string"), F.col("subscription_id").cast("string")),
    })
    return keyed.join(won, ["__nk", "__jk"], "left_anti").select("subscription_id", "opportunity_id")
