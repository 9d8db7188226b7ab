"""Loads take effect all at once: failures leave the old rows, keys are enforced, content is reconciled."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerline import schemas
from ledgerline.functions.digest import digest, reconcile
from ledgerline.jobs import MARTS
from ledgerline.sources import bindings as b
from ledgerline.sources import files, publish

PRODUCTS, TEAMS = "product,series,sales_price\n", "sales_agent,manager,regional_office\n"


class Warehouse:
    """Two small tables in CSV files and their load."""

    def __init__(self, spark):
        self.spark, self.base = spark, tempfile.mkdtemp(prefix="ledgerline-publish-")
        self.root = f"{self.base}/wh"
        self.plan = [files.LoadStep(f"{self.base}/products.csv", "products", schemas.PRODUCTS, key=("product",)),
                     files.LoadStep(f"{self.base}/teams.csv", "sales_teams", schemas.SALES_TEAMS, key=("sales_agent",))]

    def load(self, products, teams="a,m,r\n", **options):
        for name, text in (("products", PRODUCTS + products), ("teams", TEAMS + teams)):
            with open(f"{self.base}/{name}.csv", "w") as f:
                f.write(text)
        return files.load_raw(self.spark, self.plan, self.root, **options)

    def read(self, table="products"):
        schema = schemas.RAW_TABLES[table]
        return sorted(map(tuple, files.read_table(self.spark, f"{self.root}/{table}", schema).collect()))

    def generations(self, table="products"):
        return sorted(os.listdir(f"{self.root}/{table}"))


@pytest.fixture
def wh(spark):
    return Warehouse(spark)


ONE = [("p", "s", Decimal("1.00"))]


def test_a_malformed_last_row_leaves_the_old_rows(wh):
    wh.load("p,s,1\n")
    before = wh.generations()
    many = "".join(f"q{i},s,{i}\n" for i in range(5000))
    with pytest.raises(Exception, match="sales_price"):
        wh.load(many + "bad,s,soon\n", "b,m,r\n")
    assert wh.read() == ONE and wh.read("sales_teams") == [("a", "m", "r")]
    assert wh.generations() == before  # the failed load left no files
    wh.load(many)
    assert len(wh.read()) == 5000


def test_tables_switch_together(wh):
    wh.load("p,s,1\n", "a,m,r\n")
    with pytest.raises(Exception, match="2 columns|columns|MALFORMED"):  # the second table fails after the first was written
        wh.load("q,s,2\n", "a,m,r\nb,m\n")
    assert wh.read() == ONE and wh.read("sales_teams") == [("a", "m", "r")]


@pytest.mark.parametrize("products, what", [("p,s,1\nq,s,2\np,t,3\n", "products.*'p'"), ("p,s,1\n,s,2\n", "products.*null")])
def test_keys_are_enforced(wh, products, what):
    wh.load("p,s,1\n")
    with pytest.raises(publish.KeyViolation, match=rf"(?s)\(product\) of {what}"):
        wh.load(products)
    assert wh.read() == ONE


def test_references_are_enforced(spark, wh):
    ref = publish.Reference(("series",), "sales_teams", ("sales_agent",))
    wh.plan[0] = files.LoadStep(wh.plan[0].path, "products", schemas.PRODUCTS, key=("product",), references=(ref,))
    wh.load("p,a,1\nq,,2\n")  # null refers to nothing
    with pytest.raises(publish.KeyViolation, match=r"products \(series\) refers to unknown rows of sales_teams.*'zz'"):
        wh.load("p,a,1\nr,zz,2\n")
    assert len(wh.read()) == 2
    wh.plan = wh.plan[:1]
    with pytest.raises(ValueError, match="sales_teams"):
        wh.load("p,a,1\n")


def test_readers_of_the_old_load_go_on_and_older_files_go(spark, wh):
    first = wh.load("p,s,1\n")["products"]
    wh.load("q,s,2\n")
    assert [r["product"] for r in first.collect()] == ["p"]  # kept for readers that opened it
    assert [r[0] for r in wh.read()] == ["q"]
    wh.load("r,s,3\n")
    assert [r[0] for r in wh.read()] == ["r"] and len(wh.generations()) == 2


def test_tables_not_loaded_stay_in_force(spark, wh):
    wh.load("p,s,1\n", "a,m,r\n")
    whole, wh.plan = wh.plan, wh.plan[:1]
    wh.load("q,s,2\n")
    assert wh.read("sales_teams") == [("a", "m", "r")] and [r[0] for r in wh.read()] == ["q"]
    wh.plan = whole
    wh.load("q,s,2\n", "b,m,r\n")
    assert wh.read("sales_teams") == [("b", "m", "r")]


def test_a_folder_without_a_pointer_is_read_as_it_is(spark, wh):
    spark.createDataFrame([("p", "s", Decimal("1.00"))], schemas.PRODUCTS).write.parquet(f"{wh.root}/products")
    assert wh.read() == ONE and publish.current(spark, wh.root) == {}


def test_catalog_loads_switch_too(spark, wh):
    import uuid

    db = f"ledgerline_publish_{uuid.uuid4().hex[:8]}"
    names = lambda: [r["product"] for r in spark.table(f"{db}.products").collect()]
    try:
        for p in ("p", "q", "r"):
            wh.load(f"{p},s,1\n", database=db)
            assert names() == [p]
        with pytest.raises(publish.KeyViolation):
            wh.load("x,s,1\nx,s,1\n", database=db)
        assert names() == ["r"]
        tables = [t.name for t in spark.catalog.listTables(db) if t.name.startswith("products__")]
        assert len(tables) == 2  # the current and the last generation
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_the_ordinal_is_loaded_and_the_sources_are_verified(spark, wh):
    loaded = wh.load("p,s,1\nq,s,2\n", ordinal="place", verify=True)["products"]
    assert [r["product"] for r in loaded.orderBy("place").collect()] == ["p", "q"]
    assert loaded.columns == ["product", "series", "sales_price", "place"]


# ---------------------------------------------------------------- digests


def test_a_changed_cell_changes_the_digest(spark):
    rows = [("a", 1, Decimal("1.50"), dt.date(2020, 1, 1), 0.5, True), (None, None, None, None, None, None), ("", 0, Decimal("0.00"), dt.date(1, 1, 1), 0.0, False)]
    kind = "s string, i int, d decimal(12,2), t date, f double, b boolean"
    df = spark.createDataFrame(rows, kind)
    base = tuple(digest(df).head())
    assert base == tuple(digest(df.repartition(3)).head()) and base[0] == 3
    seen = {base}
    changed = [("b", 2, Decimal("1.51"), dt.date(2020, 1, 2), 0.500001, False)]
    for r in range(3):
        for c in range(6):
            if rows[r][c] != (v := changed[0][c]):
                other = [list(x) for x in rows]
                other[r][c] = v
                seen.add(tuple(digest(spark.createDataFrame([tuple(x) for x in other], kind)).head()))
    assert len(seen) == 18  # 17 changes (one cell holds the value already), all different
    assert tuple(digest(df.unionByName(df)).head()) != base  # repeated rows count
    assert tuple(digest(spark.createDataFrame([("ab", "c")], "x string, y string")).head()) != tuple(digest(spark.createDataFrame([("a", "bc")], "x string, y string")).head())
    assert tuple(digest(df.where("false")).head()) == (0, "0-0")


def test_exported_marts_hold_the_same_content(spark):
    t = b.tables(spark, SMALL)
    marts = {n: fn(t) for n, fn in MARTS.items()}
    base = tempfile.mkdtemp(prefix="ledgerline-marts-")
    paths = files.export_marts(marts, base)
    assert all(r["same_content"] and r["expected_rows"] == r["actual_rows"] for r in files.check_export(spark, marts, paths).collect())
    # one changed cell, row counts equal
    card = files.read_marts(spark, marts, paths)["vw_agent_scorecard"]
    some = card.select(F.min("sales_agent")).head()[0]
    wrong = card.withColumn("won_deals", F.when(F.col("sales_agent") == some, F.col("won_deals") + 1).otherwise(F.col("won_deals")))
    got = reconcile({"card": card}, {"card": wrong}).head()
    assert got["expected_rows"] == got["actual_rows"] and not got["same_content"]


def test_empty_texts_and_nulls_are_one_in_csv(spark):
    marts = {"m": spark.createDataFrame([("", 1), (None, 2), ("x", None)], "s string, k int")}
    paths = files.export_marts(marts, tempfile.mkdtemp(prefix="ledgerline-marts-"))
    assert files.check_export(spark, marts, paths).head()["same_content"]
    assert not reconcile(marts, files.read_marts(spark, marts, paths)).head()["same_content"]


def test_the_manifest_holds_the_digests(spark, wh):
    tables = wh.load("p,s,1\nq,s,2\n")
    entry = publish.current(spark, wh.root)["products"]
    assert (entry["rows"], entry["digest"]) == tuple(digest(tables["products"]).head())
