"""Hand-made frames for nulls, ties, empty input and unknown values."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import checks, crm_export, marts, postsale, presale
from ledgerline.operators.subscriptions import derive_subscriptions

d = dt.date
FIX = {"GTXPro": "GTX Pro"}


def pipeline(spark, rows):
    return spark.createDataFrame(rows, schemas.SALES_PIPELINE)


def subs(spark, rows):
    return spark.createDataFrame(rows, schemas.SUBSCRIPTIONS)


def teams(spark):
    return spark.createDataFrame([("ann", "M1", "West"), ("bob", "M1", "West"), ("cy", "M2", "East"),
                                  ("idle", "M2", "East")], schemas.SALES_TEAMS)


def products(spark):
    return spark.createDataFrame([("GTX Pro", "GTX", D("4821.00")), ("MG", "MG", D("55.00"))], schemas.PRODUCTS)


def deals(spark):
    return pipeline(spark, [
        ("o1", "ann", "GTXPro", "acc1", "Won", d(2017, 1, 1), d(2017, 1, 11), D("100.00")),
        ("o2", "ann", "MG", "acc1", "Lost", d(2017, 1, 1), d(2017, 1, 5), D("0.00")),
        ("o3", "bob", "MG", "acc2", "Won", d(2017, 2, 1), d(2017, 2, 3), D("100.00")),
        ("o4", "dan", "MG", None, "Engaging", d(2017, 3, 1), None, None),       # agent without team row
        ("o5", "eve", "GTXPro", None, "Prospecting", None, None, None),          # open deals only
        ("o6", "ann", "Unknown", "acc2", "Stalled", d(2017, 3, 1), None, None),  # unknown stage
        ("o7", None, None, "acc3", "Won", d(2017, 4, 1), d(2017, 4, 2), D("50.00")),
    ])


def test_scorecard_ties_nulls_and_missing_agents(spark):
    card = {r["sales_agent"]: r for r in marts.agent_scorecard(deals(spark), teams(spark)).collect()}
    assert set(card) == {"ann", "bob", "dan", "eve", None}          # 'cy' and 'idle' have no deals
    assert card["ann"]["bookings_rank"] == 1 and card["bob"]["bookings_rank"] == 1   # tie
    assert card[None]["bookings_rank"] == 3                          # rank has a gap after a tie
    assert card["dan"]["manager"] is None                            # no team row: kept, null manager
    assert card["eve"]["win_rate_pct"] is None                       # no closed deal
    assert card["eve"]["bookings_rank"] == 4 and card["dan"]["bookings_rank"] == 4   # null bookings last
    assert card["ann"]["win_rate_pct"] == 50.0


def test_win_rate_groups(spark):
    by_agent = {r["sales_agent"]: r for r in presale.win_rate(deals(spark), ["sales_agent"]).collect()}
    assert by_agent["eve"]["win_rate_pct"] is None and None in by_agent
    by_manager = {r["manager"]: r for r in presale.win_rate_by_team(deals(spark), teams(spark), "manager").collect()}
    assert set(by_manager) == {"M1"}                                 # inner join: dan, eve, null agent drop
    assert (by_manager["M1"]["won"], by_manager["M1"]["lost"]) == (2, 1)


def test_quarter_rank_nulls_first(spark):
    rows = [("a", "x", "p", "c", "Won", d(2017, 1, 1), d(2017, 1, 2), D("10.00")),
            ("b", "y", "p", "c", "Won", d(2017, 1, 1), d(2017, 1, 3), D("10.00")),
            ("c", "z", "p", "c", "Won", d(2017, 1, 1), d(2017, 1, 4), D("5.00")),
            ("e", "w", "p", "c", "Won", d(2017, 1, 1), d(2017, 1, 5), None)]
    out = {r["sales_agent"]: r["rank_in_quarter"] for r in presale.agent_quarter_rank(pipeline(spark, rows)).collect()}
    assert out == {"w": 1, "x": 2, "y": 2, "z": 4}


def test_stage_snapshot_unknown_stage_last(spark):
    snap = presale.stage_snapshot(deals(spark)).collect()
    assert [r["deal_stage"] for r in snap] == ["Prospecting", "Engaging", "Won", "Lost", "Stalled"]
    assert snap[0]["pct_of_previous_stage"] is None
    assert snap[2]["pct_of_previous_stage"] == 300.0 and snap[4]["pct_of_previous_stage"] == 100.0


def test_weighted_forecast_drops_unknown_products(spark):
    out = {r["deal_stage"]: r for r in presale.weighted_forecast(deals(spark), products(spark), FIX).collect()}
    assert out["Engaging"]["estimated_value"] == D("55.00")
    assert out["Engaging"]["weighted_pipeline"] == D("33.00")
    assert out["Prospecting"]["estimated_value"] == D("4821.00")
    assert out["Prospecting"]["weighted_pipeline"] == D("482.10")


def test_summary_keeps_every_row_and_fans_out_on_duplicate_dims(spark):
    accounts = spark.createDataFrame([("acc1", "technolgy", 2000, D("1.50"), 10, "Philipines", None)],
                                     schemas.ACCOUNTS)
    m1 = marts.pipeline_summary(deals(spark), products(spark), teams(spark), accounts, FIX,
                                {"technolgy": "technology"}, {"Philipines": "Philippines"})
    assert m1.count() == 7
    row = m1.filter(F.col("opportunity_id") == "o1").first()
    assert (row["product"], row["sector"], row["office_location"]) == ("GTX Pro", "technology", "Philippines")
    assert row["forecast_category"] == "Closed" and row["sales_cycle_days"] == 10
    assert m1.filter(F.col("opportunity_id") == "o4").first()["estimated_value"] == D("55.00")
    dup = products(spark).unionByName(products(spark).filter(F.col("product") == "MG"))
    assert checks.duplicate_keys(dup, ["product"]).collect()[0]["occurrences"] == 2
    fanned = marts.pipeline_summary(deals(spark), dup, teams(spark), accounts, FIX, {}, {})
    assert fanned.count() == 7 + 3                                   # three MG deals doubled


def test_retention_empty_input_keeps_total_row(spark):
    out = marts.retention_summary(subs(spark, []), FIX).collect()
    assert len(out) == 1
    total = out[0]
    assert total["product"] == "ALL PRODUCTS" and total["total_subscriptions"] == 0
    assert total["churned_count"] == 0 and total["expanded_count"] == 0
    assert total["total_starting_arr"] is None and total["grr_pct"] is None and total["logo_churn_pct"] is None


def test_retention_null_outcome_and_null_product_and_label_clash(spark):
    rows = [("s1", "o1", "a", "GTXPro", "x", d(2017, 1, 1), d(2018, 1, 1), D("100.00"), "Expansion", D("120.00")),
            ("s2", "o2", "a", "GTX Pro", "x", d(2017, 1, 1), d(2018, 1, 1), D("100.00"), "Churned", D("0.00")),
            ("s3", "o3", "a", None, "x", d(2017, 1, 1), d(2018, 1, 1), D("100.00"), None, None),
            ("s4", "o4", "a", "ALL PRODUCTS", "x", d(2017, 1, 1), d(2018, 1, 1), D("100.00"), "Renewed Flat",
             D("100.00"))]
    out = marts.retention_summary(subs(spark, rows), FIX).collect()
    labels = sorted((r["product"] is None, r["product"] or "") for r in out)
    assert len(out) == 4 and labels.count((False, "ALL PRODUCTS")) == 2
    total = [r for r in out if r["product"] == "ALL PRODUCTS" and r["total_subscriptions"] == 4][0]
    # renewal null: least() ignores it, so GRR counts the start in full (100 + 0 + 100 + 100) / 400
    assert total["grr_pct"] == 75.0 and total["nrr_pct"] == 55.0
    assert total["expansion_rate_pct"] == 50.0                       # null outcome is not renewed
    gtx = [r for r in out if r["product"] == "GTX Pro"][0]
    assert gtx["total_subscriptions"] == 2 and gtx["logo_churn_pct"] == 50.0
    headline = marts.retention_headline(marts.retention_summary(subs(spark, rows), FIX))
    assert headline.count() == 2                                     # the reference filter, as written


def test_ntile_small_inputs(spark):
    def tiles(n):
        rows = [(f"s{i}", "o", "a", "p", "x", d(2017, 1, 1), d(2018, 1, 1), D(str(i)), "Churned", D("0"))
                for i in range(n)]
        out = postsale.churn_by_size_quartile(subs(spark, rows)).collect()
        return [r["total"] for r in out]
    assert tiles(5) == [2, 1, 1, 1]
    assert tiles(3) == [1, 1, 1]


def test_derived_subscription_dates_and_partition_independence(spark):
    rows = [(f"o{i}", "a", "p", "c", "Won", d(2024, 1, 1), d(2024, 1 + i % 12, 28 + i % 2), D("10.00"))
            for i in range(40)]
    rows.append(("late", "a", "p", "c", "Won", d(2024, 1, 1), d(2024, 2, 29), D("10.00")))
    rows.append(("gap", "a", "p", "c", "Won", d(2024, 1, 1), None, D("10.00")))
    base = pipeline(spark, rows)
    one = derive_subscriptions(base.coalesce(1)).orderBy("subscription_id").collect()
    many = derive_subscriptions(base.repartition(7)).orderBy("subscription_id").collect()
    assert one == many and len(one) == 41
    late = [r for r in one if r["opportunity_id"] == "late"][0]
    assert late["renewal_date"] == d(2025, 2, 28)


def test_untraceable_filter_belongs_to_the_join(spark):
    sub = subs(spark, [("s1", "o1", "a", "p", "x", d(2017, 1, 1), d(2018, 1, 1), D("1"), "Churned", D("0")),
                       ("s2", None, "a", "p", "x", d(2017, 1, 1), d(2018, 1, 1), D("1"), "Churned", D("0")),
                       ("s3", "o3", "a", "p", "x", d(2017, 1, 1), d(2018, 1, 1), D("1"), "Churned", D("0"))])
    pipe = pipeline(spark, [("o1", "a", "p", "c", "Won", None, None, None),
                            ("o3", "a", "p", "c", "Lost", None, None, None)])
    got = sorted(r["subscription_id"] for r in checks.untraceable_subscriptions(sub, pipe).collect())
    assert got == ["s2", "s3"]


def test_crm_opportunities_placeholders(spark):
    opps = {r["Opportunity_ID__c"]: r for r in
            crm_export.crm_opportunities(deals(spark), products(spark), FIX, "2024-01-01").collect()}
    assert "o4" not in opps and "o5" not in opps                     # no account: excluded
    assert opps["o6"]["Stage"] is None and opps["o6"]["Amount"] == D("0.00")
    assert opps["o6"]["Close Date"] == "2017-05-30"                  # engage + 90 days
    assert opps["o1"]["Opportunity Name"] == "acc1 - GTX Pro"
    assert opps["o7"]["Opportunity Name"] is None                    # null product poisons the name
    rec = crm_export.export_reconciliation(deals(spark), crm_export.crm_opportunities(
        deals(spark), products(spark), FIX, "2024-01-01")).first()
    assert rec["reconciled"] and rec["expected_rows"] == 5


def test_near_duplicates_and_like(spark):
    df = spark.createDataFrame([("Acme",), (" acme",), ("ACME ",), ("Zed",), (None,), (None,)], "account string")
    out = {r["normalized_name"]: r for r in checks.near_duplicate_names(df, "account").collect()}
    assert out["acme"]["variants"] == " acme, ACME , Acme" and out["acme"]["occurrences"] == 3
    assert out[None]["variants"] is None and out[None]["occurrences"] == 2
    repeats = spark.createDataFrame([("Acme",), ("Acme",), (" acme",), ("Acme",)], "account string")
    rep = checks.near_duplicate_names(repeats, "account").first()
    assert rep["variants"] == " acme, Acme x3" and rep["occurrences"] == 4
    like = checks.values_like(df, "account", "acm%").collect()
    assert sorted(r["account"] for r in like) == ["ACME ", "Acme"]
