"""Cross-job invariants on the bound test tables (sf0.01)."""

from pyspark.sql import functions as F

from conftest import MEDIUM
from ledgerline.catalog import QUERIES
from ledgerline.sources import bindings as b


def _one(spark, name):
    return QUERIES[name](spark, MEDIUM).first()


def test_summary_row_count_equals_pipeline(spark):
    assert _one(spark, "summary_row_count")["row_count"] == b.roles(spark, MEDIUM).pipeline.count()


def test_won_adds_up_across_groupings(spark):
    overall = _one(spark, "win_rate_overall")
    for name in ("win_rate_by_agent", "win_rate_by_product"):
        agg = QUERIES[name](spark, MEDIUM).agg(F.sum("won"), F.sum("lost")).first()
        assert (agg[0], agg[1]) == (overall["won"], overall["lost"])


def test_retention_total_is_sum_of_products(spark):
    df = QUERIES["retention_summary"](spark, MEDIUM)
    total = df.filter(F.col("product") == "ALL PRODUCTS").first()
    # null-safe: the null-product row is a detail row too
    parts = df.filter(~F.col("product").eqNullSafe("ALL PRODUCTS")).agg(
        F.sum("total_subscriptions"), F.sum("total_starting_arr"), F.sum("total_renewal_arr"),
        F.sum("churned_count"), F.sum("expanded_count")).first()
    assert tuple(parts) == (total["total_subscriptions"], total["total_starting_arr"], total["total_renewal_arr"],
                            total["churned_count"], total["expanded_count"])
    assert total["grr_pct"] <= 100.0


def test_grr_never_exceeds_nrr_or_100(spark):
    r = _one(spark, "grr_nrr")
    assert r["grr_pct"] <= 100.0
    sanity = _one(spark, "retention_sanity")
    assert (sanity["grr_pct"], sanity["nrr_pct"]) == (r["grr_pct"], r["nrr_pct"])
    assert sanity["logo_churn_pct"] == _one(spark, "logo_churn")["logo_churn_pct"]


def test_export_reconciles(spark):
    rec = _one(spark, "export_reconciliation")
    assert rec["reconciled"] and rec["actual_rows"] + rec["excluded_no_account"] == rec["source_rows"]
    audit = _one(spark, "id_match_audit")
    assert audit["matched"] == QUERIES["attach_external_ids"](spark, MEDIUM).count()
    assert audit["matched"] + audit["unmatched"] == rec["actual_rows"]


def test_quartiles_cover_all_subscriptions(spark):
    tiles = QUERIES["churn_by_size_quartile"](spark, MEDIUM).collect()
    sizes = [r["total"] for r in tiles]
    assert sum(sizes) == _one(spark, "logo_churn")["total_subscriptions"]
    assert max(sizes) - min(sizes) <= 1
    for lo, hi in zip(tiles, tiles[1:]):
        assert lo["max_arr_in_quartile"] <= hi["min_arr_in_quartile"]


def test_checks_find_planted_rows(spark):
    assert QUERIES["closed_orphans"](spark, MEDIUM).count() > 0
    assert [r[0] for r in QUERIES["unknown_products"](spark, MEDIUM).collect()] == ["Brand7"]
    assert QUERIES["duplicate_keys"](spark, MEDIUM).count() > 0
    assert QUERIES["near_duplicate_names"](spark, MEDIUM).count() == b.read(spark, MEDIUM, "customer").count()
    assert QUERIES["untraceable_subscriptions"](spark, MEDIUM).count() > 0
    assert QUERIES["unmatched_sample"](spark, MEDIUM).count() == 10
    statuses = {r["match_status"] for r in QUERIES["product_match_status"](spark, MEDIUM).collect()}
    assert statuses == {"NOT IN products table", "matches products table"}
