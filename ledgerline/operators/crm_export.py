"""CRM import tables, their reconciliation and the external-id merge."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.cleaning import canonicalize_values, mapped
from ledgerline.functions.digest import reconcile
from ledgerline.plans.joins import join_dimension

# CRM stage names and the placeholder horizon for missing close dates.
STAGE_MAP = {
    "Prospecting": "Prospecting",
    "Engaging": "Negotiation/Review",
    "Won": "Closed Won",
    "Lost": "Closed Lost",
}
PLACEHOLDER_DAYS = 90


def crm_accounts(accounts: DataFrame, sector_fixes: Mapping[str, str],
                 country_fixes: Mapping[str, str]) -> DataFrame:
    """Account import rows; revenue from millions to units, a founding description."""
    # parts that are not known are left out of the description
    founded = F.concat(F.lit("Founded "), F.col("year_established").cast("string"))
    parent = F.concat(F.lit("subsidiary of "), F.col("subsidiary_of"))
    return accounts.select(
        F.col("account").alias("Account Name"),
        mapped("sector", sector_fixes).alias("Industry"),
        (F.col("revenue").cast("decimal(38,2)") * F.lit(1_000_000)).cast("decimal(38,2)").alias("Annual Revenue"),
        F.col("employees").alias("NumberOfEmployees"),
        mapped("office_location", country_fixes).alias("BillingCountry"),
        F.concat_ws("; ", founded, parent).alias("Description"),
    )


def _price_list(products: DataFrame, ordinal: str | None = None) -> DataFrame:
    # One price per product name: a lookup keeps a single value where a SQL
    # join would fan out. With the rows' places in their source the last one of a
    # duplicate counts, as in a dictionary; otherwise the highest listed price.
    price = F.max_by("sales_price", ordinal) if ordinal else F.max("sales_price")
    return products.groupBy("product").agg(price.alias("sales_price"))


def crm_opportunities(pipeline: DataFrame, products: DataFrame, product_fixes: Mapping[str, str],
                      as_of: str | dt.date, stage_map: Mapping[str, str] = STAGE_MAP,
                      horizon_days: int = PLACEHOLDER_DAYS, ordinal: str | None = None) -> DataFrame:
    """Opportunity import rows for deals with an account.

    ``ordinal`` names the source-place column of ``products`` (see ``files.read_csv``): the last listed price
    of a repeated product counts then.

    Close date: close_date, else engage_date + horizon, else as_of + horizon.
    Amount: close_value, else the cleaned product's list price, else 0.
    ``as_of`` is an argument so results never depend on the clock.
    """
    as_of_col = F.lit(str(as_of)).cast("date")
    deals = canonicalize_values(pipeline.filter(F.col("account").isNotNull()), {"product": product_fixes})
    priced = join_dimension(deals, _price_list(products, ordinal), "product", how="left", spread_col="opportunity_id")
    close = F.coalesce(F.col("close_date"), F.date_add("engage_date", horizon_days),
                       F.date_add(as_of_col, horizon_days))
    amount = F.coalesce(F.col("close_value").cast("decimal(38,2)"), F.col("sales_price").cast("decimal(38,2)"),
                        F.lit(0).cast("decimal(38,2)"))
    return priced.select(
        F.concat(F.col("account"), F.lit(" - "), F.col("product")).alias("Opportunity Name"),
        F.col("account").alias("Account Name"),
        amount.alias("Amount"),
        F.date_format(close, "yyyy-MM-dd").alias("Close Date"),
        mapped("deal_stage", stage_map, keep_unmapped=False).alias("Stage"),
        F.col("product").alias("Product"),
        F.col("sales_agent").alias("Sales Agent"),
        F.col("opportunity_id").alias("Opportunity_ID__c"),
    )


def export_reconciliation(pipeline: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Source rows - rows without account = exported rows, as one row with a flag."""
    # one aggregation over both inputs (tagged rows of a union), no join
    tagged = pipeline.select(F.lit(True).alias("__src"), F.col("account").isNull().alias("__excl")) \
                     .unionByName(opportunities.select(F.lit(False).alias("__src"), F.lit(False).alias("__excl")))
    counts = tagged.agg(F.count_if(F.col("__src")).alias("source_rows"),
                        F.count_if(F.col("__src") & F.col("__excl")).alias("excluded_no_account"),
                        F.count_if(~F.col("__src")).alias("actual_rows"))
    expected = F.col("source_rows") - F.col("excluded_no_account")
    return counts.select("source_rows", "excluded_no_account", expected.alias("expected_rows"), "actual_rows",
                         (expected == F.col("actual_rows")).alias("reconciled"))


def assert_reconciled(reconciliation: DataFrame) -> None:
    """Raise like the reference's assert when the export lost or gained rows."""
    row = reconciliation.first()
    if not row["reconciled"]:
        raise AssertionError(f"export does not reconcile: {row.asDict()}")


def content_reconciliation(expected: Mapping[str, DataFrame], written: Mapping[str, DataFrame]) -> DataFrame:
    """C3 by content: (file_name, expected_rows, actual_rows, same_content) of the import files read back.

    Row counts agree although a cell was damaged; digests do not. CSV cannot tell empty texts from nulls.
    """
    return reconcile(dict(expected), dict(written), "file_name", empty_as_null=True)


def assert_same_content(reconciliation: DataFrame) -> None:
    """Raise if a file's content differs from what was exported."""
    wrong = [r.asDict() for r in reconciliation.where("not same_content").collect()]  # a row a file at most
    if wrong:
        raise AssertionError(f"exported content differs: {wrong}")


def value_distribution(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """Rows per non-null value (like ``value_counts``), most frequent first."""
    c = out_col or col
    return df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias(c)) \
             .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(c))


def placeholder_counts(pipeline: DataFrame) -> DataFrame:
    """Exported rows that received a placeholder close date / an estimated amount."""
    exported = pipeline.filter(F.col("account").isNotNull())
    return exported.agg(F.count_if(F.col("close_date").isNull()).alias("placeholder_close_dates"),
                        F.count_if(F.col("close_value").isNull()).alias("estimated_amounts"))


def _with_match(opportunities: DataFrame, ids: DataFrame) -> DataFrame:
    right = ids.withColumn("__hit", F.lit(True))
    # Plain equality: a null name never matches. A data-frame merge would pair
    # null with null, but the export has no row without an account name.
    return join_dimension(opportunities, right, "Account Name", "Name", how="left",
                          spread_col="Opportunity_ID__c")


def attach_external_ids(opportunities: DataFrame, ids: DataFrame) -> DataFrame:
    """Matched rows only, the name replaced by ``AccountId`` in second place; other id columns at the end."""
    matched = _with_match(opportunities, ids).filter(F.col("__hit"))
    rest = [c for c in opportunities.columns if c not in ("Opportunity Name", "Account Name")]
    more = [c for c in ids.columns if c not in ("Name", "Id")]
    clash = sorted(set(more) & set(opportunities.columns))
    if clash:
        raise ValueError(f"the id list has columns of the opportunities: {', '.join(clash)}")
    return matched.select("Opportunity Name", F.col("Id").alias("AccountId"), *rest, *more)


def _id_counts(ids: DataFrame) -> DataFrame:
    """One row for each name of the id list, with the number of its ids."""
    return ids.where(F.col("Name").isNotNull()).groupBy("Name").agg(F.count(F.lit(1)).alias("__ids"))


def id_match_audit(opportunities: DataFrame, ids: DataFrame) -> DataFrame:
    """Matched and unmatched row counts of the id merge, and what names with several ids do to it.

    ``names_with_several_ids`` counts the names that occur more than once in the list and in an opportunity,
    ``rows_gained`` the rows by which the merge exceeds the opportunities. Names are counted before
    the join on both sides, so a repeated name never multiplies rows here.
    """
    names = opportunities.groupBy("Account Name").agg(F.count(F.lit(1)).alias("__rows"))
    met = join_dimension(names, _id_counts(ids), "Account Name", "Name", how="left", spread_col="__rows")
    n, rows = F.col("__ids"), F.col("__rows")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return met.agg(total(F.when(n.isNotNull(), rows * n)).alias("matched"), total(F.when(n.isNull(), rows)).alias("unmatched"),
                   F.count_if(n > 1).alias("names_with_several_ids"), total(F.when(n > 1, rows * (n - 1))).alias("rows_gained"))


def names_with_several_ids(opportunities: DataFrame, ids: DataFrame) -> DataFrame:
    """(Account Name, ids, opportunities, rows_gained) of every name that the merge repeats."""
    names = opportunities.groupBy("Account Name").agg(F.count(F.lit(1)).alias("opportunities"))
    met = names.join(_id_counts(ids).where("__ids > 1"), F.col("Account Name") == F.col("Name"))
    return met.select("Account Name", F.col("__ids").alias("ids"), "opportunities", (F.col("opportunities") * (F.col("__ids") - 1)).alias("rows_gained"))


def unmatched_sample(opportunities: DataFrame, ids: DataFrame, n: int = 10, ordinal: str | None = None) -> DataFrame:
    """The first n distinct unmatched account names, by name, or by first occurrence if ``ordinal`` names
    the source-place column of ``opportunities``."""
    m = _with_match(opportunities, ids).filter(F.col("__hit").isNull())
    if ordinal:
        first = m.groupBy("Account Name").agg(F.min(ordinal).alias("__first"))
        return first.orderBy("__first").limit(n).select("Account Name")
    return m.select("Account Name").distinct().orderBy(F.asc_nulls_last("Account Name")).limit(n)
