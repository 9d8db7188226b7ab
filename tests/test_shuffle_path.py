"""Dimension joins give the same rows when no dimension may be broadcast."""

from collections import Counter

from conftest import SMALL
from ledgerline.catalog import QUERIES

JOBS = ["pipeline_summary", "agent_scorecard", "win_rate_by_manager", "deal_size_by_sector", "crm_opportunities",
        "attach_external_ids", "id_match_audit", "weighted_forecast", "untraceable_subscriptions"]
OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def test_shuffle_joins_match_broadcast_joins(spark):
    expected = {name: Counter(QUERIES[name](spark, SMALL).collect()) for name in JOBS}
    saved = {k: spark.conf.get(k, None) for k in OFF}
    try:
        for k, v in OFF.items():
            spark.conf.set(k, v)
        for name in JOBS:
            df = QUERIES[name](spark, SMALL)
            assert Counter(df.collect()) == expected[name], name
        summary = QUERIES["pipeline_summary"](spark, SMALL)
        summary.collect()
        plan = summary._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan.split("== Initial Plan ==")[0]
        assert "__nk" in plan and "__dnk" in plan      # null account / agent keys spread over reducers
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_and_null_keys_on_the_shuffle_path(spark):
    import datetime as dt
    from decimal import Decimal

    from ledgerline import schemas
    from ledgerline.operators import marts

    rows = []
    for i in range(3000):
        account = "HOT" if i % 3 == 0 else (None if i % 3 == 1 else f"acc{i % 50}")
        stage = "Won" if i % 2 else "Engaging"
        rows.append((f"o{i}", f"agent{i % 7}", "MG", account, stage, dt.date(2017, 1, 1),
                     dt.date(2017, 2, 1) if stage == "Won" else None, Decimal("10.00") if stage == "Won" else None))
    pipe = spark.createDataFrame(rows, schemas.SALES_PIPELINE).repartition(6)
    accounts = spark.createDataFrame([("HOT", "retail", 2000, Decimal("1.00"), 5, "X", None)] +
                                     [(f"acc{j}", "tech", 2001, Decimal("2.00"), 6, "Y", None) for j in range(50)],
                                     schemas.ACCOUNTS)
    teams = spark.createDataFrame([(f"agent{j}", "M", "R") for j in range(7)], schemas.SALES_TEAMS)
    products = spark.createDataFrame([("MG", "MG", Decimal("55.00"))], schemas.PRODUCTS)

    def summary():
        return Counter(marts.pipeline_summary(pipe, products, teams, accounts, {}, {}, {}).collect())

    expected = summary()
    saved = {k: spark.conf.get(k, None) for k in OFF}
    try:
        for k, v in OFF.items():
            spark.conf.set(k, v)
        got = summary()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected and sum(got.values()) == 3000
    assert sum(n for r, n in got.items() if r["account"] is None and r["sector"] is None) == 1000
    assert sum(n for r, n in got.items() if r["account"] == "HOT" and r["sector"] == "retail") == 1000
