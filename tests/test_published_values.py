"""
and the account export on hand-made rows."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.config import REFERENCE_CLEANING
from ledgerline.functions.ratios import pct_half_up, ratio_half_up
from ledgerline.operators.crm_export import crm_accounts
from ledgerline.operators.presale import win_rate_by_team


def test_published_rates(spark):
    rows = [("win rate", 4238, 6711, 63.2), ("expansion rate", 656, 3851, 17.0)]
    df = spark.createDataFrame([(a, b) for _, a, b, _ in rows], "n long, d long")
    got = [r[0] for r in df.select(pct_half_up("n", "d", 1)).collect()]
    assert got == [want for *_, want in rows]
    # 4,238 won of 6,711 closed as a plain ratio with 4 digits (pipeline velocity input)
    assert df.select(ratio_half_up("n", "d", 4)).first()[0] == 0.6315


def test_published_manager_and_region_rates(spark):
    # per-agent partial counts that add up to the published group totals
    teams = spark.createDataFrame([("a1", "Cara Losch", "East"), ("a2", "Cara Losch", "East"),
                                   ("w1", "Other", "West"), ("w2", "Other2", "West")], schemas.SALES_TEAMS)
    rows = []
    for agent, won, lost in (("a1", 300, 200), ("a2", 180, 65), ("w1", 1000, 500), ("w2", 438, 311)):
        rows += [(f"{agent}-w{i}", agent, "p", "acc", "Won", None, None, D("1.00")) for i in range(won)]
        rows += [(f"{agent}-l{i}", agent, "p", "acc", "Lost", None, None, D("0.00")) for i in range(lost)]
    pipe = spark.createDataFrame(rows, schemas.SALES_PIPELINE)
    by_manager = {r["manager"]: r for r in win_rate_by_team(pipe, teams, "manager").collect()}
    assert (by_manager["Cara Losch"]["won"], by_manager["Cara Losch"]["lost"]) == (480, 265)
    assert by_manager["Cara Losch"]["win_rate_pct"] == 64.4
    by_region = {r["regional_office"]: r for r in win_rate_by_team(pipe, teams, "regional_office").collect()}
    assert (by_region["West"]["won"], by_region["West"]["lost"]) == (1438, 811)
    assert by_region["West"]["win_rate_pct"] == 63.9


def test_account_export_rows(spark):
    accounts = spark.createDataFrame([
        ("Acme Corporation", "technolgy", 1990, D("1250.75"), 3000, "United States", None),
        ("Beta Labs", "medical", 1999, D("251.41"), 495, "Philipines", None),
        ("Bluth", "retail", 2000, D("3.50"), 10, "Korea", "Acme Corporation"),
        ("Nulls", None, None, None, None, None, None),
    ], schemas.ACCOUNTS)
    out = {r["Account Name"]: r for r in crm_accounts(accounts, REFERENCE_CLEANING.sector,
                                                       REFERENCE_CLEANING.crm_country).collect()}
    acme = out["Acme Corporation"]
    assert (acme["Industry"], acme["Annual Revenue"], acme["Description"]) == (
        "technology", D("1250750000.00"), "Founded 1990")
    assert out["Beta Labs"]["BillingCountry"] == "Philippines"
    assert out["Bluth"]["BillingCountry"] == "Korea, Republic of"
    assert out["Bluth"]["Description"] == "Founded 2000; subsidiary of Acme Corporation"
    assert out["Nulls"]["Description"] == "" and out["Nulls"]["Annual Revenue"] is None
    assert crm_accounts(accounts, {}, {}).filter(F.col("Industry") == "technolgy").count() == 1
