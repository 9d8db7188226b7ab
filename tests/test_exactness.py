"""Totals beyond 2^63, weights with their own scale, and joins that compare keys in their own types."""

from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from conftest import SMALL
from ledgerline import schemas
from ledgerline.catalog import QUERIES
from ledgerline.functions.ratios import scaled_half_up
from ledgerline.operators import presale
from ledgerline.plans.joins import join_dimension

RANKED_OR_IO = {"load_raw", "row_counts", "export_marts", "load_digests", "mart_digests", "crm_digests",
                "agent_quarter_rank", "agent_scorecard", "churn_by_size_quartile",
                "sequential_subscription_ids"}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10 ** 27, 10 ** 27), st.integers(1, 10 ** 4)), min_size=1, max_size=20))
def test_rounding_past_64_bits(spark, pairs):
    df = spark.createDataFrame([(Decimal(n), Decimal(d)) for n, d in pairs], "n decimal(38,0), d decimal(38,0)")
    got = [int(r[0]) for r in df.select(scaled_half_up("n", "d", 60)).collect()]
    want = [(2 * abs(n) * 60 + d) // (2 * d) * (1 if n >= 0 else -1) for n, d in pairs]
    assert got == want


def test_sixty_percent_of_a_large_total(spark):
    df = spark.createDataFrame([(Decimal(9 * 10 ** 19),)], "n decimal(38,0)")
    assert df.select(scaled_half_up("n", F.lit(100), 60)).first()[0] == Decimal(54 * 10 ** 18)


def test_weights_keep_their_scale(spark):
    deals = spark.createDataFrame([("o", "a", "p", "x", "Engaging", None, None, Decimal("1000.00"))], schemas.SALES_PIPELINE)
    products = spark.createDataFrame([("p", "s", Decimal("1.00"))], schemas.PRODUCTS)
    row = presale.weighted_forecast(deals, products, {}, {"Engaging": ("Commit", Decimal("0.125"))}).first()
    assert row["category_weight"] == Decimal("0.125") and row["weighted_pipeline"] == Decimal("125.00")


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_int_meets_decimal_keys(spark, threshold):
    fact = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, None), (5, 9)], "id int, k int")
    dim = spark.createDataFrame([(Decimal("1.00"), "one"), (Decimal("2.00"), "two"), (None, "none")], "k decimal(10,2), name string")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.set(n, threshold)
        rows = Counter(tuple(r) for r in join_dimension(fact, dim, "k", spread_col="id").select("id", "name").collect())
        inner = Counter(tuple(r) for r in join_dimension(fact, dim, "k", how="inner").select("id", "name").collect())
    finally:
        for n, v in saved.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    assert rows == Counter([(1, "one"), (2, "two"), (3, None), (4, None), (5, None)])
    assert inner == Counter([(1, "one"), (2, "two")])


def test_building_a_job_starts_none(spark):
    for name in QUERIES.keys() - RANKED_OR_IO:
        QUERIES[name](spark, SMALL)  # Parquet footers are read here
    sc = spark.sparkContext
    for name in sorted(QUERIES.keys() - RANKED_OR_IO):
        sc.setJobGroup(f"build-{name}", name)
        try:
            QUERIES[name](spark, SMALL)
            assert not sc.statusTracker().getJobIdsForGroup(f"build-{name}"), name
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
