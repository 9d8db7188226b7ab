"""Binding of the five raw-layer roles onto the TPC-H-like test tables.

The reference's fact files are not public, so tests and the bench derive the
roles from ``/root/testdata/sf*/``: ``orders`` plays the opportunity,
``customer`` the account, ``supplier`` the sales agent, ``p_brand`` the
product. The binding plants the reference's dirt (null accounts on open
deals, a misspelt product, sector and location) so every check has work.
The same definitions exist as SQL in ``ledgerline.oracle`` for DuckDB.
Everything is lazy: Catalyst prunes what a job does not use.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import Cleaning
from ledgerline.operators.subscriptions import derive_subscriptions
from ledgerline.plans.joins import join_dimension

# Fixed values of the binding (the planted misspellings and their fixes).
PLANTED_PRODUCT = ("Brand#7", "Brand7")
PLANTED_SECTOR = ("MACHINERY", "MACHINRY")
PLANTED_LOCATION = ("NATION_7", "NATON_7")

PRODUCT_FIXES = {"Brand7": "Brand#7"}
SECTOR_FIXES = {"MACHINRY": "MACHINERY"}
LOCATION_FIXES = {"NATON_7": "NATION_7"}
# The CRM export maps one more country spelling than the analytics layer.
CRM_COUNTRY_FIXES = {"NATON_7": "NATION_7", "NATION_9": "NATION_9, Republic of"}
AS_OF = "2024-01-01"
CLEANING = Cleaning(product=PRODUCT_FIXES, sector=SECTOR_FIXES, location=LOCATION_FIXES,
                    crm_country=CRM_COUNTRY_FIXES)


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Reuse a bound role per session: a DataFrame is an immutable plan, so
    sharing it between jobs caches no rows, only the analysis work."""
    plans = spark.__dict__.setdefault("_ledgerline_plans", {})
    if key not in plans:
        plans[key] = build()
    return plans[key]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table as a DataFrame. The resolved scan (file listing and
    Parquet footer schema) is kept per session and reused by every job; it
    is only a plan, no rows are cached."""
    scans = spark.__dict__.setdefault("_ledgerline_scans", {})
    key = (sf_dir, name)
    if key not in scans:
        scans[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return scans[key]


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    bad_sector, bad_loc = PLANTED_SECTOR, PLANTED_LOCATION
    key = F.col("c_custkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(
                 F.col("c_name").alias("account"),
                 F.when(F.col("c_mktsegment") == bad_sector[0], F.lit(bad_sector[1]))
                  .otherwise(F.col("c_mktsegment")).alias("sector"),
                 (F.lit(1980) + key % 40).cast("int").alias("year_established"),
                 F.abs("c_acctbal").cast("decimal(12,2)").alias("revenue"),
                 (F.lit(10) + key % 5000).cast("int").alias("employees"),
                 F.when(F.col("n_name") == bad_loc[0], F.lit(bad_loc[1]))
                  .otherwise(F.col("n_name")).alias("office_location"),
                 F.when((key % 6 == 0) & (key > 0),
                        F.concat(F.lit("Customer#"), F.lpad((key % 100).cast("string"), 9, "0")))
                  .alias("subsidiary_of"),
             ))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return (p.groupBy(F.col("p_brand").alias("product"))
             .agg(F.min("p_type").alias("series"),
                  F.max("p_retailprice").cast("decimal(12,2)").alias("sales_price")))


def sales_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
             .select(F.col("s_name").alias("sales_agent"), F.col("n_name").alias("manager"),
                     F.col("r_name").alias("regional_office")))


def sales_pipeline(spark: SparkSession, sf_dir: str, closed_orphan_every: int | None = None,
                   lost_every: int | None = None) -> DataFrame:
    """The opportunity fact. ``closed_orphan_every`` / ``lost_every`` plant the
    FIXTURES section 4 variants (account nulled on some Won rows, some Won
    rows turned Lost); they alter values, every order is still present."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    li = read(spark, sf_dir, "lineitem")
    # Name lookups keyed by their primary key. Grouping by the key makes the
    # uniqueness visible to Catalyst, so a job that uses neither the agent nor
    # the product drops these left joins (and the line-item aggregate) entirely.
    s = read(spark, sf_dir, "supplier").groupBy("s_suppkey").agg(F.min("s_name").alias("s_name"))
    p = read(spark, sf_dir, "part").groupBy("p_partkey").agg(F.min("p_brand").alias("p_brand"))
    first_line = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("sk"), F.min("l_partkey").alias("pk"))
    od = F.col("o_orderdate").cast("date")
    stage = (F.when(F.col("o_orderstatus") == "F", "Won")
              .when(F.col("o_orderstatus") == "P", "Lost")
              .when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Engaging")
              .otherwise("Prospecting"))
    if lost_every:
        stage = F.when((F.col("o_orderkey") % lost_every == 0) & (stage == "Won"), "Lost").otherwise(stage)
    o = o.select("o_orderkey", "o_custkey", "o_totalprice", od.alias("od"), stage.alias("stage"))
    is_open = F.col("stage").isin("Prospecting", "Engaging")
    null_account = is_open & (F.col("o_orderkey") % 3 == 0)
    if closed_orphan_every:
        null_account = null_account | ((F.col("stage") == "Won") & (F.col("o_orderkey") % closed_orphan_every == 0))
    bad_brand, planted = PLANTED_PRODUCT
    joined = (o.join(c, o.o_custkey == c.c_custkey)
               .join(first_line, F.col("l_orderkey") == F.col("o_orderkey"), "left")
               .join(s, F.col("sk") == F.col("s_suppkey"), "left")
               .join(p, F.col("pk") == F.col("p_partkey"), "left"))
    return joined.select(
        F.concat(F.lit("OPP-"), F.col("o_orderkey").cast("string")).alias("opportunity_id"),
        F.col("s_name").alias("sales_agent"),
        F.when(F.col("p_brand") == bad_brand, F.lit(planted)).otherwise(F.col("p_brand")).alias("product"),
        F.when(null_account, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("account"),
        F.col("stage").alias("deal_stage"),
        F.when(F.col("stage") != "Prospecting", F.col("od")).alias("engage_date"),
        F.when(F.col("stage").isin("Won", "Lost"),
               F.date_add(F.col("od"), (F.col("o_custkey") % 120).cast("int"))).alias("close_date"),
        F.when(F.col("stage") == "Won", F.col("o_totalprice").cast("decimal(12,2)"))
         .when(F.col("stage") == "Lost", F.lit(0).cast("decimal(12,2)")).alias("close_value"),
    )


def external_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM id list (Name, Id) with one row per account; a tenth of the names
    carry a trailing space, the name mismatch an id merge has to report
    (C7-C9): their opportunities find no id."""
    c = read(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.col("c_name"), F.lit(" "))).otherwise(F.col("c_name"))
    return c.select(name.alias("Name"),
                    F.concat(F.lit("001"), F.lpad(F.col("c_custkey").cast("string"), 15, "0")).alias("Id"))


def account_name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer name twice, the second copy re-cased and space-prefixed
    (V7 fixture: one near-duplicate group per customer, so it grows with the data)."""
    c = read(spark, sf_dir, "customer").select(F.col("c_name").alias("account"))
    variant = c.select(F.upper(F.concat(F.lit(" "), F.lower("account"))).alias("account"))
    return c.unionByName(variant)


# Fixtures that plant what a check has to find (values only; every row stays).
FINE_FORECAST = {"Prospecting": ("Pipeline", Decimal("0.125")), "Engaging": ("Commit", Decimal("0.605"))}
PLANTED_YEAR = 1999  # accounts founded then stand for "some accounts"


def orders_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per market segment over ``join_dimension`` with BIGINT = DECIMAL keys; a third of the keys is null."""
    o = read(spark, sf_dir, "orders")
    fact = o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("customer"))
    dim = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("decimal(12,2)").alias("key"), "c_mktsegment")
    met = join_dimension(fact, dim, "customer", "key", spread_col="o_orderkey")
    return met.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("orders"))


def renamed_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of the planted year under another name, so their deals find no account (V3)."""
    a = tables(spark, sf_dir).accounts
    return a.withColumn("account", F.when(F.col("year_established") == PLANTED_YEAR, F.concat("account", F.lit(" Inc.")))
                        .otherwise(F.col("account")))


def repeated_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accounts, and those of the planted year once more as they are and once re-cased (V7)."""
    a = tables(spark, sf_dir).accounts.select("account", "year_established")
    some = a.where(F.col("year_established") == PLANTED_YEAR)
    return a.unionByName(some).unionByName(some.withColumn("account", F.upper(F.concat(F.lit(" "), F.lower("account")))))


def repeated_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline with its Lost rows twice (V6)."""
    p = tables(spark, sf_dir).pipeline
    return p.unionByName(p.where(F.col("deal_stage") == "Lost"))


def incomplete_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline without the value of deals closed on a 13th."""
    p = tables(spark, sf_dir).pipeline
    return p.withColumn("close_value", F.when(F.coalesce(F.dayofmonth("close_date") != 13, F.lit(True)), F.col("close_value")))


def accounts_with_decoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with a location that matches the misspelt one only if its underscore is a wildcard."""
    a = tables(spark, sf_dir).accounts
    return a.withColumn("office_location", F.when(F.col("office_location") == "NATION_9", F.lit("NATONX7")).otherwise(F.col("office_location")))


def tables_without_some_years(spark: SparkSession, sf_dir: str):
    """The tables with the planted founding year unknown."""
    from dataclasses import replace

    t = tables(spark, sf_dir)
    year = F.when(F.col("year_established") != PLANTED_YEAR, F.col("year_established")).alias("year_established")
    return replace(t, accounts=t.accounts.select(*[year if c == "year_established" else F.col(c) for c in t.accounts.columns]))


def tables_with_repeated_ids(spark: SparkSession, sf_dir: str):
    """The tables with an id list in which every seventh customer's name has a second id."""
    from dataclasses import replace

    t = tables(spark, sf_dir)
    again = read(spark, sf_dir, "customer").where(F.col("c_custkey") % 7 == 0).select(
        F.col("c_name").alias("Name"), F.concat(F.lit("002"), F.lpad(F.col("c_custkey").cast("string"), 15, "0")).alias("Id"))
    return replace(t, external_ids=t.external_ids.unionByName(again))


def account_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value map as large as the accounts (CLN1): every third customer's name gets a suffix."""
    c = read(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 == 0)
    return c.select(F.col("c_name").alias("bad"), F.concat("c_name", F.lit(" Ltd")).alias("good"))


@dataclass
class Roles:
    spark: SparkSession
    sf_dir: str

    @property
    def accounts(self) -> DataFrame:
        return _memo(self.spark, ("accounts", self.sf_dir), lambda: accounts(self.spark, self.sf_dir))

    @property
    def products(self) -> DataFrame:
        return _memo(self.spark, ("products", self.sf_dir), lambda: products(self.spark, self.sf_dir))

    @property
    def sales_teams(self) -> DataFrame:
        return _memo(self.spark, ("sales_teams", self.sf_dir), lambda: sales_teams(self.spark, self.sf_dir))

    @property
    def pipeline(self) -> DataFrame:
        return _memo(self.spark, ("pipeline", self.sf_dir), lambda: sales_pipeline(self.spark, self.sf_dir))

    @property
    def subscriptions(self) -> DataFrame:
        return _memo(self.spark, ("subscriptions", self.sf_dir), lambda: derive_subscriptions(self.pipeline))

    def table(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)


def roles(spark: SparkSession, sf_dir: str) -> Roles:
    return Roles(spark, sf_dir)


def tables(spark: SparkSession, sf_dir: str):
    """The bound roles as a ``jobs.Tables`` (binding cleaning maps, fixed export date)."""
    from ledgerline.jobs import Tables

    def build():
        r = roles(spark, sf_dir)
        return Tables(accounts=r.accounts, products=r.products, sales_teams=r.sales_teams, pipeline=r.pipeline,
                      subscriptions_table=r.subscriptions, external_ids=external_ids(spark, sf_dir),
                      cleaning=CLEANING, as_of=AS_OF)
    cache = spark.__dict__.setdefault("_ledgerline_tables", {})
    if sf_dir not in cache:
        cache[sf_dir] = build()
    return cache[sf_dir]
