"""Value maps (CLN1) and the small conditional helpers built on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.joins import join_dimension

CASE_LIMIT = 64  # entries of a value map that is written as a CASE chain; a larger one is joined


def mapped(col, mapping: Mapping, keep_unmapped: bool = True) -> Column:
    """Exact, case-sensitive value map as a CASE chain.

    ``keep_unmapped`` True is ``Series.replace`` / ``CASE ... ELSE x`` (X3, X4);
    False is ``Series.map`` / ``CASE`` without ELSE (X5): unmapped -> null.
    Null input stays null either way. The maps are a handful of entries, so a
    CASE chain inside the projection (whole-stage codegen, no join) is cheapest.
    """
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for bad, good in mapping.items():
        cond = c == F.lit(bad)
        out = F.when(cond, F.lit(good)) if out is None else out.when(cond, F.lit(good))
    if out is None:
        return c if keep_unmapped else F.lit(None).cast("string")
    return out.otherwise(c) if keep_unmapped else out


def map_table(fixes: DataFrame) -> DataFrame:
    """(bad, good) from the first two columns of ``fixes``; a spelling with two different fixes raises when the map is used.

    Null spellings are left out (null passes through a value map); repeated equal entries count once.
    """
    bad, good = fixes.columns[:2]
    pairs = fixes.select(F.col(f"`{bad}`").alias("bad"), F.col(f"`{good}`").alias("good")).where("bad is not null")
    one = pairs.groupBy("bad").agg(F.min("good").alias("good"), F.max("good").alias("other"), F.count("good").alias("n"), F.count(F.lit(1)).alias("all"))
    clash = F.expr("good <> other or (n > 0 and n < all)")
    refused = F.raise_error(F.concat(F.lit("More than one fix for: "), F.col("bad").cast("string")))
    # in the key, so that no plan can leave the check out
    return one.select(F.when(F.coalesce(clash, F.lit(False)), refused.cast(one.schema["bad"].dataType)).otherwise(F.col("bad")).alias("bad"), "good")


def mapped_by_table(df: DataFrame, col: str, fixes: DataFrame, keep_unmapped: bool = True) -> DataFrame:
    """``mapped`` for a map of any size: a left join with the map table instead of a CASE chain.

    Rows without a value are spread in a shuffled join and never match; each spelling occurs once in the
    map, so no row is repeated. Catalyst broadcasts the map by its size in bytes.
    """
    fixes = map_table(fixes).select(F.col("bad").alias("__bad"), F.col("good").alias("__good"), F.lit(True).alias("__hit"))
    row_id = next((c for c in df.columns if c != col), col)
    met = join_dimension(df, fixes, col, "__bad", how="left", spread_col=row_id)
    good = F.when(F.col("__hit"), F.col("__good"))
    value = good.when(F.col("__hit").isNull(), F.col(f"`{col}`")) if keep_unmapped else good
    return met.select(*[value.alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])


def canonicalize_values(df: DataFrame, maps: Mapping[str, Mapping | DataFrame]) -> DataFrame:
    """CLN1: replace known bad spellings per column; unmapped and null pass through.

    A map is a mapping or a DataFrame (bad, good). Mappings of up to ``CASE_LIMIT`` entries become
    CASE chains of one projection; larger ones and DataFrames are joined.
    """
    here = {c: m for c, m in maps.items() if c in df.columns}
    small = {c: m for c, m in here.items() if not isinstance(m, DataFrame) and len(m) <= CASE_LIMIT}
    out = df.withColumns({c: mapped(c, m) for c, m in small.items()}) if small else df
    for c, m in here.items():
        if c not in small:
            table = m if isinstance(m, DataFrame) else df.sparkSession.createDataFrame(list(m.items()), "bad string, good string")
            out = mapped_by_table(out, c, table)
    return out
