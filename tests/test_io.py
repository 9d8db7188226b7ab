"""CSV -> typed load -> Parquet -> CSV round trip."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from ledgerline import schemas
from ledgerline.sources import files


def test_round_trip_keeps_types_and_nulls(spark):
    base = tempfile.mkdtemp(prefix="ledgerline-io-")
    rows = [("o1", " a", "GTXPro ", None, "Engaging", dt.date(2017, 1, 2), None, None),
            ("o2", "b", "MG", "acc", "Won", dt.date(2017, 1, 2), dt.date(2017, 2, 1), Decimal("12.50"))]
    src = spark.createDataFrame(rows, schemas.SALES_PIPELINE)
    files.write_csv(src, f"{base}/raw/sales_pipeline.csv", single_file=True)
    plan = [files.LoadStep(f"{base}/raw/sales_pipeline.csv", "sales_pipeline", schemas.SALES_PIPELINE)]
    loaded = files.load_raw(spark, plan, f"{base}/tables")["sales_pipeline"]
    assert loaded.schema == src.schema or [f.dataType for f in loaded.schema] == [f.dataType for f in src.schema]
    assert sorted(loaded.collect()) == sorted(src.collect())
    assert os.path.isdir(f"{base}/tables/sales_pipeline")
    paths = files.export_marts({"m": loaded}, f"{base}/out", single_file=True)
    back = spark.read.option("header", True).csv(paths["m"])
    assert back.count() == 2


def test_missing_input_names_the_table(spark):
    with pytest.raises(FileNotFoundError, match="accounts"):
        files.read_csv(spark, "/nonexistent/accounts.csv", schemas.ACCOUNTS, "accounts")


def test_bad_value_fails_the_load(spark):
    base = tempfile.mkdtemp(prefix="ledgerline-io-")
    with open(f"{base}/products.csv", "w") as fh:
        fh.write("product,series,sales_price\nGTX Pro,GTX,not-a-number\n")
    df = files.read_csv(spark, f"{base}/products.csv", schemas.PRODUCTS, "products")
    with pytest.raises(Exception):
        df.collect()


def test_require_rows(spark):
    empty = spark.createDataFrame([], schemas.PRODUCTS)
    with pytest.raises(ValueError, match="Won"):
        files.require_rows(empty, "deal_stage == 'Won'")


def test_loaded_pipeline_is_pruned_by_stage(spark):
    from pyspark.sql import functions as F
    base = tempfile.mkdtemp(prefix="ledgerline-io-")
    rows = [(f"o{i}", "a", "p", "c", stage, dt.date(2017, 1, 2), None, None)
            for i, stage in enumerate(["Won", "Lost", "Engaging", None] * 5)]
    files.write_csv(spark.createDataFrame(rows, schemas.SALES_PIPELINE), f"{base}/raw/sales_pipeline.csv")
    step = files.LoadStep(f"{base}/raw/sales_pipeline.csv", "sales_pipeline", schemas.SALES_PIPELINE,
                          ("deal_stage",))
    loaded = files.load_raw(spark, [step], f"{base}/tables")["sales_pipeline"]
    assert loaded.schema.fieldNames() == schemas.SALES_PIPELINE.fieldNames()
    assert loaded.filter(F.col("deal_stage").isNull()).count() == 5
    won = loaded.filter(F.col("deal_stage") == "Won")
    assert won.count() == 5
    plan = won._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(deal_stage" in plan and "Won" in plan


def test_bucketed_tables_colocate_the_account_join(spark):
    import uuid

    from ledgerline.operators import presale
    from ledgerline.sources import bindings as b

    base = tempfile.mkdtemp(prefix="ledgerline-io-")
    t = b.tables(spark, "/root/testdata/sf0.001")
    files.write_raw_csv(t.raw(), f"{base}/raw", f"{base}/processed")
    db = f"ledgerline_test_{uuid.uuid4().hex[:8]}"
    loaded = files.load_raw(spark, files.bucketed_plan(f"{base}/raw", f"{base}/processed", buckets=8),
                            f"{base}/wh", database=db)
    expected = presale.deal_size_by_sector(t.pipeline, t.accounts).collect()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = presale.deal_size_by_sector(loaded["sales_pipeline"], loaded["accounts"])
        assert sorted(df.collect()) == sorted(expected)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "hashpartitioning(account" not in plan        # both sides come bucketed by account
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
