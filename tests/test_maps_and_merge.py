"""Value maps of any size, the fan-out of the id merge, and choices by source place."""

import os
import tempfile
import time
from decimal import Decimal

import pytest

from ledgerline import schemas
from ledgerline.functions import cleaning
from ledgerline.functions.cleaning import canonicalize_values
from ledgerline.operators import crm_export, subscriptions
from ledgerline.sources import files

ROWS = [("a", 1), ("b", 2), (None, 3), ("x", 4), ("a", 5), ("", 6)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "v string, k int")


@pytest.mark.parametrize("fixes", [{}, {"a": "A"}, {"a": "A", "b": None, "": "empty", "zz": "q"}])
def test_a_map_table_gives_the_values_of_the_chain(spark, df, fixes, monkeypatch):
    want = sorted(map(tuple, canonicalize_values(df, {"v": fixes}).collect()), key=repr)
    table = spark.createDataFrame(list(fixes.items()), "bad string, good string")
    assert sorted(map(tuple, canonicalize_values(df, {"v": table}).collect()), key=repr) == want
    monkeypatch.setattr(cleaning, "CASE_LIMIT", 0)
    assert sorted(map(tuple, canonicalize_values(df, {"v": fixes}).collect()), key=repr) == want
    for keep in (True, False):
        chain = df.withColumn("v", cleaning.mapped("v", fixes, keep))
        joined = cleaning.mapped_by_table(df, "v", table, keep)
        assert joined.columns == df.columns
        assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, chain.collect()), key=repr)


def test_two_fixes_of_one_spelling_raise(spark, df):
    twice = spark.createDataFrame([("a", "A"), ("a", "A"), (None, "n")], "bad string, good string")
    assert canonicalize_values(df, {"v": twice}).count() == len(ROWS)  # equal entries count once
    for other in ("B", None):
        out = canonicalize_values(df, {"v": twice.unionByName(spark.createDataFrame([("a", other)], "bad string, good string"))})
        with pytest.raises(Exception, match="More than one fix for: a"):
            out.collect()


def test_a_hundred_thousand_entries(spark):
    n = 100_000
    table = spark.range(n).selectExpr("concat('bad', id) as bad", "concat('good', id) as good")
    df = spark.range(3 * n).selectExpr("case when id % 3 > 0 then concat('bad', id) end as v", "id")
    start = time.perf_counter()
    out = canonicalize_values(df, {"v": table})
    plan = out._jdf.queryExecution().executedPlan().toString()
    took = time.perf_counter() - start
    assert "Join" in plan and took < 20
    assert out.where("v like 'good%'").count() == sum(1 for i in range(n) if i % 3) and out.count() == 3 * n


# ---------------------------------------------------------------- the id merge

OPPS = "`Opportunity Name` string, `Account Name` string, Opportunity_ID__c string"


def test_repeated_names_are_reported(spark):
    opps = spark.createDataFrame([("d1", "A", "1"), ("d2", "A", "2"), ("d3", "B", "3"), ("d4", None, "4"), ("d5", "C", "5")], OPPS)
    ids = spark.createDataFrame([("A", "x"), ("A", "y"), ("A", "z"), ("B", "u"), ("D", "v"), ("D", "w"), (None, "n"), (None, "m")], schemas.EXTERNAL_IDS)
    row = crm_export.id_match_audit(opps, ids).head().asDict()
    assert row == {"matched": 7, "unmatched": 2, "names_with_several_ids": 1, "rows_gained": 4}
    assert crm_export.attach_external_ids(opps, ids).count() == 7
    assert [tuple(r) for r in crm_export.names_with_several_ids(opps, ids).collect()] == [("A", 3, 2, 4)]
    assert tuple(crm_export.id_match_audit(opps.where("false"), ids).head()) == (0, 0, 0, 0)


# ---------------------------------------------------------------- source order


def csv(name, text):
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-order-"), name)
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("parts", [1, 5])
def test_the_last_price_the_first_names_and_the_file_order(spark, parts):
    products = files.read_csv(spark, csv("p.csv", "product,series,sales_price\nX,s,9\nY,s,3\nX,s,2\n"), schemas.PRODUCTS, ordinal="place").repartition(parts)
    deals = spark.createDataFrame([("o1", "ag", "X", "acc", "Engaging", None, None, None)], schemas.SALES_PIPELINE)
    assert crm_export.crm_opportunities(deals, products, {}, "2024-01-01", ordinal="place").head()["Amount"] == Decimal("2.00")
    assert crm_export.crm_opportunities(deals, products, {}, "2024-01-01").head()["Amount"] == Decimal("9.00")

    from pyspark.sql import types as T

    kind = T.StructType([T.StructField(c, T.StringType()) for c in ("Opportunity Name", "Account Name", "Opportunity_ID__c")])
    names = ["z", "a", "z", "m", "known", "b"]
    opps = files.read_csv(spark, csv("o.csv", "Opportunity Name,Account Name,Opportunity_ID__c\n" + "".join(f"d,{n},{i}\n" for i, n in enumerate(names))), kind, ordinal="place").repartition(parts)
    ids = spark.createDataFrame([("known", "1")], schemas.EXTERNAL_IDS)
    assert [r[0] for r in crm_export.unmatched_sample(opps, ids, 3, ordinal="place").collect()] == ["z", "a", "m"]

    won = files.read_csv(spark, csv("w.csv", "Opportunity Name,Account Name,Opportunity_ID__c\n" + "".join(f"d,n,{i}\n" for i in (7, 3, 9, 1))), kind, ordinal="place").repartition(parts)
    numbered = subscriptions.number_subscriptions(won, order_by=("place",))
    assert {r["subscription_id"]: r["Opportunity_ID__c"] for r in numbered.collect()} == {"SUB-00001": "7", "SUB-00002": "3", "SUB-00003": "9", "SUB-00004": "1"}


def test_a_damaged_import_file_is_found_though_the_counts_agree(spark):
    deals = spark.createDataFrame([("a", "A", None), ("b", "B", Decimal("2.50"))], "`Opportunity Name` string, `Account Name` string, Amount decimal(38,2)")
    path = tempfile.mkdtemp(prefix="ledgerline-crm-") + "/o.csv"
    files.write_csv(deals, path)
    read = lambda: {"o": files.read_csv(spark, path, deals.schema, "o")}
    crm_export.assert_same_content(crm_export.content_reconciliation({"o": deals}, read()))
    files.write_csv(deals.fillna({"Account Name": "x"}).replace("B", "C"), path)
    found = crm_export.content_reconciliation({"o": deals}, read())
    assert [tuple(r) for r in found.collect()] == [("o", 2, 2, False)]
    with pytest.raises(AssertionError, match="content differs"):
        crm_export.assert_same_content(found)
