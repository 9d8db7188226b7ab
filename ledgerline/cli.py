"""Command line for the reference's workflow, step by step.

    python -m ledgerline derive-subscriptions --raw-dir data/raw --out data/processed/subscriptions.csv
    python -m ledgerline load --raw-dir data/raw --processed-dir data/processed --warehouse wh
    python -m ledgerline run win_rate_by_manager grr_nrr --warehouse wh
    python -m ledgerline sql "SELECT * FROM analytics_vw_retention_summary" --warehouse wh
    python -m ledgerline export-marts --warehouse wh --out-dir data/processed/marts
    python -m ledgerline crm-export --raw-dir data/raw --out-dir data/processed/crm --as-of 2024-01-01
    python -m ledgerline merge-ids --ids accounts_export.csv \
        --opportunities data/processed/crm/crm_opportunities_import.csv --out with_ids.csv

CSV inputs are read with the typed schemas (``ledgerline.schemas``); outputs
are CSV directories (``--single-file`` writes one part file for small
outputs). Summaries are printed with ``show``, which fetches a bounded
number of rows only.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.jobs import JOBS, MARTS, Tables
from ledgerline.operators import crm_export, subscriptions
from ledgerline.sources import files, views

OPPORTUNITY_IMPORT = T.StructType([
    T.StructField("Opportunity Name", T.StringType()),
    T.StructField("Account Name", T.StringType()),
    T.StructField("Amount", T.DecimalType(38, 2)),
    T.StructField("Close Date", T.StringType()),
    T.StructField("Stage", T.StringType()),
    T.StructField("Product", T.StringType()),
    T.StructField("Sales Agent", T.StringType()),
    T.StructField("Opportunity_ID__c", T.StringType()),
])


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from ledgerline.session import build_session
    return build_session(master="local[*]")


def _warehouse_tables(spark: SparkSession, warehouse: str | None, ids: str | None, as_of: str | None,
                      database: str | None = None) -> Tables:
    if not (database or warehouse):
        raise SystemExit("give --warehouse (table files) or --database (catalog tables)")
    if database:   # catalog tables keep their bucketing
        read = {name: spark.table(f"`{database}`.`{name}`").select(*st.fieldNames())
                for name, st in schemas.RAW_TABLES.items()}
    else:
        read = {name: files.read_table(spark, f"{warehouse}/{name}", st) for name, st in schemas.RAW_TABLES.items()}
    ext = files.read_csv(spark, ids, schemas.EXTERNAL_IDS, "external ids") if ids else None
    return Tables(accounts=read["accounts"], products=read["products"], sales_teams=read["sales_teams"],
                  pipeline=read["sales_pipeline"], subscriptions_table=read["subscriptions"], external_ids=ext,
                  as_of=as_of)


def cmd_derive(spark: SparkSession, a) -> None:
    pipeline = files.read_csv(spark, f"{a.raw_dir}/sales_pipeline.csv", schemas.SALES_PIPELINE, "sales_pipeline")
    files.require_rows(pipeline.filter("deal_stage = 'Won'"), "deal_stage == 'Won'")
    subs = subscriptions.derive_subscriptions(pipeline, seed=a.seed)
    if a.sequential_ids:
        subs = subscriptions.number_subscriptions(subs)
    files.write_csv(subs, a.out, a.single_file)
    subscriptions.dropped_incomplete_won(pipeline).show()
    written = files.read_csv(spark, a.out, schemas.SUBSCRIPTIONS, "subscriptions")
    subscriptions.outcome_distribution(written).show()
    subscriptions.retention_sanity(written).show()


def cmd_load(spark: SparkSession, a) -> None:
    if a.database and not a.buckets:
        raise SystemExit("--database needs --buckets")
    plan = (files.bucketed_plan(a.raw_dir, a.processed_dir, a.buckets) if a.database
            else files.default_plan(a.raw_dir, a.processed_dir))
    tables = files.load_raw(spark, plan, a.warehouse, database=a.database)
    from ledgerline.operators.checks import row_counts
    row_counts({f"raw.{k}": v for k, v in tables.items()}).show()


def cmd_run(spark: SparkSession, a) -> None:
    t = _warehouse_tables(spark, a.warehouse, a.ids, a.as_of, a.database)
    for name in a.jobs:
        if name not in JOBS:
            raise SystemExit(f"unknown job {name!r}; known: {', '.join(sorted(JOBS))}")
        df = JOBS[name](t)
        if a.out:
            files.write_csv(df, f"{a.out}/{name}", a.single_file)
        else:
            print(f"== {name}")
            df.show(a.show, truncate=False)


def cmd_sql(spark: SparkSession, a) -> None:
    views.register_layers(_warehouse_tables(spark, a.warehouse, None, a.as_of, a.database), a.statement)
    spark.sql(a.statement).show(a.show, truncate=False)


def cmd_export_marts(spark: SparkSession, a) -> None:
    t = _warehouse_tables(spark, a.warehouse, None, None, a.database)
    files.export_marts({name: fn(t) for name, fn in MARTS.items()}, a.out_dir, a.single_file)


def cmd_crm(spark: SparkSession, a) -> None:
    read = lambda name, st: files.read_csv(spark, f"{a.raw_dir}/{name}.csv", st, name)
    t = Tables(accounts=read("accounts", schemas.ACCOUNTS), products=read("products", schemas.PRODUCTS),
               sales_teams=spark.createDataFrame([], schemas.SALES_TEAMS),  # not used by the export
               pipeline=read("sales_pipeline", schemas.SALES_PIPELINE), as_of=a.as_of or dt.date.today())
    exported = {name: JOBS[name](t) for name in ("crm_accounts", "crm_opportunities")}
    for name, df in exported.items():
        files.write_csv(df, f"{a.out_dir}/{name}_import.csv", a.single_file)
    written = files.read_csv(spark, f"{a.out_dir}/crm_opportunities_import.csv", OPPORTUNITY_IMPORT,
                             "opportunities import")
    rec = crm_export.export_reconciliation(t.pipeline, written)
    rec.show()
    crm_export.assert_reconciled(rec)
    back = {name: files.read_csv(spark, f"{a.out_dir}/{name}_import.csv", df.schema, name) for name, df in exported.items()}
    content = crm_export.content_reconciliation(exported, back)
    content.show()
    crm_export.assert_same_content(content)
    crm_export.value_distribution(written, "Stage").show()
    JOBS["placeholder_counts"](t).show()
    crm_export.value_distribution(written, "Product").show()


def cmd_merge(spark: SparkSession, a) -> None:
    ids = files.read_csv(spark, a.ids, schemas.EXTERNAL_IDS, "external ids")
    opps = files.read_csv(spark, a.opportunities, OPPORTUNITY_IMPORT, "opportunities import")
    crm_export.id_match_audit(opps, ids).show()
    crm_export.unmatched_sample(opps, ids).show(truncate=False)
    files.write_csv(crm_export.attach_external_ids(opps, ids), a.out, a.single_file)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="command", required=True)

    d = sub.add_parser("derive-subscriptions", help="G1: subscriptions from Won deals")
    d.add_argument("--raw-dir", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--seed", default=42)
    d.add_argument("--sequential-ids", action="store_true", help="SUB-00001 style ids (W5)")
    d.set_defaults(fn=cmd_derive)

    lo = sub.add_parser("load", help="L1/L2: typed CSV load into Parquet tables")
    lo.add_argument("--raw-dir", required=True)
    lo.add_argument("--processed-dir", required=True)
    lo.add_argument("--warehouse", required=True, help="folder of the table files")
    lo.add_argument("--database", help="also register catalog tables, account-keyed ones bucketed")
    lo.add_argument("--buckets", type=int, help="buckets of the account-keyed tables; required with --database")
    lo.set_defaults(fn=cmd_load)

    r = sub.add_parser("run", help="run named jobs on the loaded tables")
    r.add_argument("jobs", nargs="+")
    r.add_argument("--warehouse", help="folder of the loaded tables")
    r.add_argument("--database", help="read the loaded tables from this catalog database instead")
    r.add_argument("--ids", help="external id CSV (Name, Id) for the id-merge jobs")
    r.add_argument("--as-of", help="export date for crm jobs (default today)")
    r.add_argument("--out", help="write each result as CSV under this folder instead of showing it")
    r.add_argument("--show", type=int, default=20)
    r.set_defaults(fn=cmd_run)

    q = sub.add_parser("sql", help="SQL over raw_* and analytics_vw_* views")
    q.add_argument("statement")
    q.add_argument("--warehouse", help="folder of the loaded tables")
    q.add_argument("--database", help="read the loaded tables from this catalog database instead")
    q.add_argument("--as-of")
    q.add_argument("--show", type=int, default=20)
    q.set_defaults(fn=cmd_sql)

    e = sub.add_parser("export-marts", help="E1: the three marts as CSV")
    e.add_argument("--warehouse", help="folder of the loaded tables")
    e.add_argument("--database", help="read the loaded tables from this catalog database instead")
    e.add_argument("--out-dir", required=True)
    e.set_defaults(fn=cmd_export_marts)

    c = sub.add_parser("crm-export", help="C1-C6: CRM import files and their reconciliation")
    c.add_argument("--raw-dir", required=True)
    c.add_argument("--out-dir", required=True)
    c.add_argument("--as-of", help="date for placeholder close dates (default today)")
    c.set_defaults(fn=cmd_crm)

    m = sub.add_parser("merge-ids", help="C7-C9: attach external account ids")
    m.add_argument("--ids", required=True)
    m.add_argument("--opportunities", required=True)
    m.add_argument("--out", required=True)
    m.set_defaults(fn=cmd_merge)

    for s in (d, r, e, c, m):
        s.add_argument("--single-file", action="store_true", help="one part file per output (small outputs)")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    args.fn(_session(), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
