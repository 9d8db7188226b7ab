"""Every named job bound to the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

The generic jobs come from ``ledgerline.jobs`` applied to the bound tables.
A few entries use a test fixture instead (FIXTURES section 4) so that checks
which are empty on clean data have rows to find. Each entry reads the given
tables in full and returns a lazy DataFrame; only the ranked jobs
materialise a checkpoint, and the I/O jobs write into a fresh folder under
the session's checkpoint directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.digest import digests
from ledgerline.functions.cleaning import canonicalize_values
from ledgerline.jobs import JOBS, MARTS
from ledgerline.operators import checks, presale, subscriptions
from ledgerline.operators.subscriptions import derive_subscriptions
from ledgerline.session import ensure_checkpoint_dir, remove_at_exit
from ledgerline.sources import bindings as b
from ledgerline.sources import files

Query = Callable[[SparkSession, str], DataFrame]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder inside the shared checkpoint directory (never machine-local on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-{label}-{uuid.uuid4().hex}"


def _load_round_trip(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """L1 end to end, in the reference's order: the four bound source tables are
    written as CSV, subscriptions are derived from the pipeline CSV (G1) and
    written next to them, then everything is loaded with the typed plan into
    Parquet tables; the loaded tables are returned.

    Every call loads anew; its files are removed when the application ends.
    """
    base = scratch_dir(spark, "load")
    raw, processed = f"{base}/raw", f"{base}/processed"
    t = b.tables(spark, sf_dir)
    for name, df in {"accounts": t.accounts, "products": t.products, "sales_teams": t.sales_teams,
                     "sales_pipeline": t.pipeline}.items():
        files.write_csv(df, f"{raw}/{name}.csv")
    source = files.read_csv(spark, f"{raw}/sales_pipeline.csv", schemas.SALES_PIPELINE, "sales_pipeline")
    files.write_csv(derive_subscriptions(source), f"{processed}/subscriptions.csv")
    loaded = files.load_raw(spark, files.default_plan(raw, processed), f"{base}/tables")
    remove_at_exit(spark, base)
    return loaded


def _export_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three marts written as CSV, then counted back from the files."""
    t = b.tables(spark, sf_dir)
    base = scratch_dir(spark, "marts")
    paths = files.export_marts({name: fn(t) for name, fn in MARTS.items()}, base)
    remove_at_exit(spark, base)
    counted = None
    for name, path in paths.items():
        c = spark.read.option("header", True).option("multiLine", True).options(**files.QUOTING).csv(path).agg(F.count(F.lit(1)).alias("row_count")) \
                 .select(F.lit(name).alias("mart"), "row_count")
        counted = c if counted is None else counted.unionByName(c)
    return counted


def _load_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 by content: the digest of every loaded table, taken from its Parquet files."""
    return digests(_load_round_trip(spark, sf_dir)).withColumnRenamed("rows", "row_count")


def _mart_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 by content: the three marts written as CSV, read back and digested."""
    t = b.tables(spark, sf_dir)
    base = scratch_dir(spark, "marts")
    marts = {name: fn(t) for name, fn in MARTS.items()}
    paths = files.export_marts(marts, base)
    remove_at_exit(spark, base)
    return digests(files.read_marts(spark, marts, paths), "mart").withColumnRenamed("rows", "row_count")


def _crm_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 / C2 by content: both import files written as CSV, read back and digested."""
    t = b.tables_without_some_years(spark, sf_dir)
    base = scratch_dir(spark, "crm")
    tables = {name: JOBS[name](t) for name in ("crm_accounts", "crm_opportunities")}
    for name, df in tables.items():
        files.write_csv(df, f"{base}/{name}")
    remove_at_exit(spark, base)
    back = {name: files.read_csv(spark, f"{base}/{name}", df.schema, name) for name, df in tables.items()}
    return digests(back, "file_name").withColumnRenamed("rows", "row_count")


def _job(name: str) -> Query:
    return lambda spark, sf_dir: JOBS[name](b.tables(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "load_raw": lambda s, d: _load_round_trip(s, d)["sales_pipeline"],
    "row_counts": lambda s, d: checks.row_counts({f"raw.{k}": v for k, v in _load_round_trip(s, d).items()}),
}
QUERIES.update({name: _job(name) for name in JOBS})
QUERIES.update({
    # fixtures with planted rows (FIXTURES section 4)
    "closed_orphans": lambda s, d: checks.closed_orphans(b.sales_pipeline(s, d, closed_orphan_every=500)),
    "duplicate_keys": lambda s, d: checks.duplicate_keys(b.read(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "near_duplicate_names": lambda s, d: checks.near_duplicate_names(b.account_name_variants(s, d), "account"),
    "sector_typos": lambda s, d: checks.values_like(b.tables(s, d).accounts, "sector", "machinr%"),
    # the underscore is escaped; the planted decoy NATONX7 must not count
    "location_typos": lambda s, d: checks.values_like(b.accounts_with_decoy(s, d), "office_location", r"naton\_7"),
    "unknown_accounts": lambda s, d: checks.unmatched_keys(b.tables(s, d).pipeline, b.renamed_accounts(s, d), "account"),
    "duplicate_opportunity_ids": lambda s, d: checks.duplicate_keys(b.repeated_pipeline(s, d), ["opportunity_id"]),
    "near_duplicate_accounts": lambda s, d: checks.near_duplicate_names(b.repeated_accounts(s, d), "account"),
    "dropped_incomplete_won": lambda s, d: subscriptions.dropped_incomplete_won(b.incomplete_pipeline(s, d)),
    # a dimension key of another number type than the fact's, and weights of three digits
    "orders_by_segment": lambda s, d: b.orders_by_segment(s, d),
    "weighted_forecast_fine": lambda s, d: presale.weighted_forecast(
        b.tables(s, d).pipeline, b.tables(s, d).products, b.CLEANING.product, b.FINE_FORECAST),
    "crm_accounts": lambda s, d: JOBS["crm_accounts"](b.tables_without_some_years(s, d)),
    "untraceable_subscriptions": lambda s, d: checks.untraceable_subscriptions(
        b.tables(s, d).subscriptions, b.sales_pipeline(s, d, lost_every=100)),
    "export_marts": _export_marts,
    # reconciliation by content
    "load_digests": _load_digests,
    "mart_digests": _mart_digests,
    "crm_digests": _crm_digests,
    # an id list with names that have two ids
    "id_match_audit_repeated": lambda s, d: JOBS["id_match_audit"](b.tables_with_repeated_ids(s, d)),
    "names_with_several_ids": lambda s, d: JOBS["names_with_several_ids"](b.tables_with_repeated_ids(s, d)),
    "attach_repeated_ids": lambda s, d: JOBS["attach_external_ids"](b.tables_with_repeated_ids(s, d)),
    # a value map with an entry for every account, as a table
    "canonicalize_accounts": lambda s, d: canonicalize_values(b.tables(s, d).pipeline, {"account": b.account_fixes(s, d)}),
})
