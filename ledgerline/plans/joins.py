"""Dimension joins: one native-typed equi-join, null keys spread over the reducers.

Fact tables grow with the data; dimensions may or may not. No dimension is
broadcast on faith and none is counted while a plan is built: Catalyst and AQE
broadcast a side by its size in bytes, otherwise the join shuffles, and AQE
splits hot keys.

In a shuffled left join every null key would hash to one reducer (open deals
without an account are a third of the open pipeline). ``join_dimension``
therefore joins on a second key as well: 0 for rows with a key, a hash of the
row's id for rows without. A null key still never matches, since the first
condition is never true for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                   how: str = "left", spread_col: str | None = None) -> DataFrame:
    """Equi-join ``fact.fact_key = dim.dim_key`` (inner or left), dimension key dropped.

    Keys are compared in their own types. ``spread_col`` names a column of the
    fact that differs between rows; it spreads null keys in a left join.
    """
    if how not in ("left", "inner"):
        raise ValueError("join_dimension supports 'left' and 'inner'")
    d = dim.withColumnRenamed(dim_key or fact_key, "__dk")
    if how == "inner" or spread_col is None:
        # Inner joins drop null keys before the shuffle (Catalyst adds IsNotNull).
        return fact.join(d, F.col(fact_key) == F.col("__dk"), how).drop("__dk")
    f = fact.withColumn("__nk", F.when(F.col(fact_key).isNull(), F.xxhash64(spread_col)).otherwise(F.lit(0)))
    # depends on the key, so that Catalyst keeps it as a join key instead of folding a literal into the condition
    d = d.withColumn("__dnk", F.when(F.col("__dk").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return f.join(d, (F.col(fact_key) == F.col("__dk")) & (F.col("__nk") == F.col("__dnk")), "left") \
            .drop("__nk", "__dk", "__dnk")
