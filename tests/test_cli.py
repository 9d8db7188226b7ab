"""The command line end to end on CSV files written from the smallest binding."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL
from ledgerline import cli, schemas
from ledgerline.catalog import QUERIES
from ledgerline.sources import bindings as b
from ledgerline.sources import files


def test_reference_workflow(spark, capsys):
    base = tempfile.mkdtemp(prefix="ledgerline-cli-")
    raw, processed, wh, out = (f"{base}/{d}" for d in ("raw", "processed", "wh", "out"))
    t = b.tables(spark, SMALL)
    for name, df in {"accounts": t.accounts, "products": t.products, "sales_teams": t.sales_teams,
                     "sales_pipeline": t.pipeline}.items():
        files.write_csv(df, f"{raw}/{name}.csv", single_file=True)
    files.write_csv(b.external_ids(spark, SMALL), f"{base}/ids.csv", single_file=True)

    assert cli.main(["derive-subscriptions", "--raw-dir", raw, "--out", f"{processed}/subscriptions.csv"]) == 0
    assert cli.main(["load", "--raw-dir", raw, "--processed-dir", processed, "--warehouse", wh]) == 0
    assert cli.main(["run", "win_rate_overall", "grr_nrr", "--warehouse", wh, "--out", out,
                     "--single-file"]) == 0
    win = spark.read.option("header", True).csv(f"{out}/win_rate_overall").first()
    expected = QUERIES["win_rate_overall"](spark, SMALL).first()
    assert (int(win["won"]), int(win["lost"]), float(win["win_rate_pct"])) == tuple(expected)
    grr = spark.read.option("header", True).csv(f"{out}/grr_nrr").first()
    assert float(grr["grr_pct"]) == QUERIES["grr_nrr"](spark, SMALL).first()["grr_pct"]

    db = "ledgerline_cli_test"
    assert cli.main(["load", "--raw-dir", raw, "--processed-dir", processed, "--warehouse", f"{base}/wh2",
                     "--database", db, "--buckets", "4"]) == 0
    try:
        assert cli.main(["run", "deal_size_by_sector", "--database", db, "--out", f"{base}/bucketed",
                         "--single-file"]) == 0
        assert cli.main(["run", "deal_size_by_sector", "--warehouse", wh, "--out", f"{base}/plain",
                         "--single-file"]) == 0
        read = lambda d: sorted(spark.read.option("header", True).csv(f"{base}/{d}/deal_size_by_sector").collect())
        assert read("bucketed") == read("plain")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")

    assert cli.main(["sql", "SELECT COUNT(*) AS n FROM analytics_vw_pipeline_summary", "--warehouse", wh]) == 0
    assert str(t.pipeline.count()) in capsys.readouterr().out

    assert cli.main(["export-marts", "--warehouse", wh, "--out-dir", f"{base}/marts"]) == 0
    assert sorted(os.listdir(f"{base}/marts")) == ["vw_agent_scorecard", "vw_pipeline_summary",
                                                      "vw_retention_summary"]

    assert cli.main(["crm-export", "--raw-dir", raw, "--out-dir", f"{base}/sf", "--as-of", "2024-01-01"]) == 0
    opps = files.read_csv(spark, f"{base}/sf/crm_opportunities_import.csv", cli.OPPORTUNITY_IMPORT)
    assert opps.count() == t.pipeline.filter(F.col("account").isNotNull()).count()

    assert cli.main(["merge-ids", "--ids", f"{base}/ids.csv", "--opportunities",
                     f"{base}/sf/crm_opportunities_import.csv", "--out", f"{base}/with_ids.csv"]) == 0
    merged = spark.read.option("header", True).csv(f"{base}/with_ids.csv")
    assert merged.columns[:2] == ["Opportunity Name", "AccountId"] and "Account Name" not in merged.columns
    assert 0 < merged.count() < opps.count()


def test_sequential_ids(spark):
    subs = b.tables(spark, SMALL).subscriptions
    from ledgerline.operators.subscriptions import number_subscriptions
    numbered = number_subscriptions(subs.repartition(5)).orderBy("subscription_id").collect()
    assert numbered[0]["subscription_id"] == "SUB-00001"
    assert [r["opportunity_id"] for r in numbered] == sorted(r["opportunity_id"] for r in numbered)
    assert len({r["subscription_id"] for r in numbered}) == subs.count()
    assert schemas.SUBSCRIPTIONS.fieldNames() == list(numbered[0].asDict())
