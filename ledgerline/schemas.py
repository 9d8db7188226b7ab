"""Typed schemas of the raw layer (five tables) and of the external id list."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

ACCOUNTS = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("year_established", T.IntegerType()),
    T.StructField("revenue", MONEY),
    T.StructField("employees", T.IntegerType()),
    T.StructField("office_location", T.StringType()),
    T.StructField("subsidiary_of", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("sales_price", MONEY),
])

SALES_TEAMS = T.StructType([
    T.StructField("sales_agent", T.StringType()),
    T.StructField("manager", T.StringType()),
    T.StructField("regional_office", T.StringType()),
])

SALES_PIPELINE = T.StructType([
    T.StructField("opportunity_id", T.StringType()),
    T.StructField("sales_agent", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("deal_stage", T.StringType()),
    T.StructField("engage_date", T.DateType()),
    T.StructField("close_date", T.DateType()),
    T.StructField("close_value", MONEY),
])

SUBSCRIPTIONS = T.StructType([
    T.StructField("subscription_id", T.StringType()),
    T.StructField("opportunity_id", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("sales_agent", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("renewal_date", T.DateType()),
    T.StructField("starting_arr", MONEY),
    T.StructField("renewal_outcome", T.StringType()),
    T.StructField("renewal_arr", MONEY),
])

EXTERNAL_IDS = T.StructType([
    T.StructField("Name", T.StringType()),
    T.StructField("Id", T.StringType()),
])

# Raw-layer table name -> schema, in load order.
RAW_TABLES = {
    "accounts": ACCOUNTS,
    "products": PRODUCTS,
    "sales_teams": SALES_TEAMS,
    "sales_pipeline": SALES_PIPELINE,
    "subscriptions": SUBSCRIPTIONS,
}

# The key of every raw-layer table: never null, never repeated. Account and product
# of the pipeline are no references on purpose: the raw layer keeps null and misspelt ones.
PRIMARY_KEYS = {
    "accounts": ("account",),
    "products": ("product",),
    "sales_teams": ("sales_agent",),
    "sales_pipeline": ("opportunity_id",),
    "subscriptions": ("subscription_id",),
}
