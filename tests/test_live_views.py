"""Ranked results as plans: building them starts no job, and a view of them follows later loads."""

import random
import tempfile
from decimal import Decimal

import pytest

from conftest import SMALL
from ledgerline import schemas
from ledgerline.operators import marts, postsale, presale, subscriptions
from ledgerline.plans import ranking
from ledgerline.plans.ranking import asc, desc, ntile, sequence
from ledgerline.sources import bindings as b
from ledgerline.sources import files, views

BUILDERS = {
    "M2": lambda t, **o: marts.agent_scorecard(t.pipeline, t.sales_teams, **o),
    "P7": lambda t, **o: presale.agent_quarter_rank(t.pipeline, **o),
    "R4b": lambda t, **o: postsale.churn_by_size_quartile(t.subscriptions, **o),
    "W5": lambda t, **o: subscriptions.number_subscriptions(t.subscriptions, **o),
}


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_building_starts_no_job_and_values_are_the_same(spark, name):
    t = b.tables(spark, SMALL)
    t.pipeline.schema, t.subscriptions.schema  # noqa: B018 - the bound tables themselves are resolved before
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    live = BUILDERS[name](t, live=True)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}") == []
    spark.sparkContext.setJobGroup("other", "")
    assert sorted(map(repr, live.collect())) == sorted(map(repr, BUILDERS[name](t).collect()))


@pytest.mark.parametrize("sampled", [ranking.SAMPLED_KEYS, 40])
def test_live_numbers_of_any_keys(spark, monkeypatch, sampled):
    monkeypatch.setattr(ranking, "SAMPLED_KEYS", sampled)
    rng = random.Random(2)
    rows = [(rng.choice([None, "OPP-", "OPP-a", "x"]), rng.choice([None, 1.5, -2.0, 7.0]), f"id{i:05d}") for i in range(2500)]
    df = spark.createDataFrame(rows, "s string, d double, id string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        keys = [asc("s", nulls_first=False), desc("d", nulls_first=True), asc("id")]
        got = {r["id"]: (r["_rn"], r["n"]) for r in sequence(df, keys, total="n", live=True).collect()}
        spread = {r["__pid"]: r["count"] for r in ranking._live_positions(df, keys).groupBy("__pid").count().collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is not None, -(r[1] or 0), r[2]))
    assert got == {r[2]: (i, len(rows)) for i, r in enumerate(order, 1)}
    assert len(spread) == 11 and max(spread.values()) < len(rows) / 2  # hot values are spread


def test_live_numbers_of_small_and_empty_tables(spark):
    for n in (0, 1, 3):
        df = spark.createDataFrame([(f"s{i}", Decimal(i)) for i in range(n)], "id string, v decimal(10,0)")
        assert sorted(r["t"] for r in ntile(df, 4, [asc("v"), asc("id")], out="t", live=True).collect()) == list(range(1, n + 1))


def test_the_same_view_shows_the_rows_of_a_later_load(spark):
    base = tempfile.mkdtemp(prefix="ledgerline-live-")
    t = b.tables(spark, SMALL)
    files.write_raw_csv(t.raw(), f"{base}/raw", f"{base}/processed")
    plan = files.default_plan(f"{base}/raw", f"{base}/processed")
    files.load_raw(spark, plan, f"{base}/wh")
    spark.sparkContext.setJobGroup("register", "")
    assert "analytics_vw_agent_scorecard" in views.register_warehouse(spark, f"{base}/wh")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("register") == []
    spark.sparkContext.setJobGroup("other", "")
    card = lambda: {r["sales_agent"]: r.asDict() for r in spark.sql("SELECT * FROM analytics_vw_agent_scorecard").collect()}
    before = card()
    last = max(before.values(), key=lambda r: r["bookings_rank"])["sales_agent"]
    more = spark.createDataFrame([("OPP-new", last, "Brand#11", None, "Won", None, None, Decimal("999999999.00"))], schemas.SALES_PIPELINE)
    files.write_csv(t.pipeline.unionByName(more), f"{base}/raw/sales_pipeline.csv")
    files.load_raw(spark, plan, f"{base}/wh")
    after = card()
    assert after[last]["bookings_rank"] == 1 and after[last]["won_deals"] == before[last]["won_deals"] + 1
    assert spark.sql("SELECT count(*) FROM raw_sales_pipeline").head()[0] == t.pipeline.count() + 1
