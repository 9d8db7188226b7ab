"""CSV sources and sinks of the raw and published layers.

CSV is read by header name with an explicit schema (never inferred): columns
may stand in any order and others may stand between them, a missing column or
a malformed value fails the load instead of silently becoming null, an integer
may be written as ``1996.0``, and empty fields are nulls. Quoting is the usual
one on both sides: quotes are doubled, quoted fields may hold line breaks. One
large file is read by many tasks (``ledgerline.sources.records``). Loaded tables
are written as Parquet, a full refresh that takes effect all at once or not at
all (``ledgerline.sources.publish``). Marts are written as CSV
directories of part files; ``single_file`` coalesces a small mart to one.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.functions.digest import digest, reconcile
from ledgerline.sources import publish, records, views


@dataclass(frozen=True)
class LoadStep:
    """One entry of a load plan: source path, target table, schema (column order)
    and the columns the written table is partitioned by (directory pruning)."""

    path: str
    table: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    # (buckets, columns): hash-bucketed catalog table, used with ``database``
    bucket_by: tuple[int, tuple[str, ...]] | None = None
    # checked before a load takes effect
    key: tuple[str, ...] = ()
    references: tuple[publish.Reference, ...] = ()
    # see ``read_csv``
    multi_line: bool | None = None


def default_plan(raw_dir: str, processed_dir: str) -> list[LoadStep]:
    """The reference's plan: four raw CSVs plus the derived subscriptions CSV."""
    steps = [
        LoadStep(f"{raw_dir}/accounts.csv", "accounts", schemas.ACCOUNTS),
        LoadStep(f"{raw_dir}/products.csv", "products", schemas.PRODUCTS),
        LoadStep(f"{raw_dir}/sales_teams.csv", "sales_teams", schemas.SALES_TEAMS),
        # Most jobs filter on the stage (Won, Lost, open): one directory per stage
        # lets a Won-only job read only the Won files.
        LoadStep(f"{raw_dir}/sales_pipeline.csv", "sales_pipeline", schemas.SALES_PIPELINE, ("deal_stage",)),
        LoadStep(f"{processed_dir}/subscriptions.csv", "subscriptions", schemas.SUBSCRIPTIONS),
    ]
    return [replace(step, key=schemas.PRIMARY_KEYS[step.table]) for step in steps]


def bucketed_plan(raw_dir: str, processed_dir: str, buckets: int) -> list[LoadStep]:
    """``default_plan`` with the account-keyed tables bucketed by account.

    Pipeline, subscriptions and accounts hashed into the same buckets let the
    per-account aggregations (deal size and churn by sector) and their join to
    ``accounts`` run without a shuffle when ``accounts`` is too large to
    broadcast. Needs a catalog (``load_raw(..., database=...)``). Choose
    ``buckets`` so that a bucket's share of the pipeline fits a task (table
    bytes / 128 MB is a start).
    """
    by_account = (buckets, ("account",))
    out = []
    for step in default_plan(raw_dir, processed_dir):
        if step.table in ("accounts", "sales_pipeline", "subscriptions"):
            step = replace(step, bucket_by=by_account)
        out.append(step)
    return out


# quotes are doubled inside quoted fields, as spreadsheet and data-frame tools write them
QUOTING = {"quote": '"', "escape": '"'}


def _typed(name: str, kind: T.DataType, date_format: str, table: str) -> Column:
    """A text column in its declared type; a value that does not fit raises an error."""
    raw = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return raw.alias(name)
    if isinstance(kind, T.DateType):
        value = F.try_to_timestamp(raw, F.lit(date_format)).cast("date")
    elif isinstance(kind, (T.IntegerType, T.LongType)):
        wide = raw.try_cast("decimal(38,10)")  # 1996 or 1996.0
        value = F.when(wide == F.floor(wide), wide.try_cast(kind))
    elif isinstance(kind, T.DecimalType):
        wide = raw.try_cast("decimal(38,10)")
        value = F.when(wide == F.round(wide, kind.scale), wide.try_cast(kind))
    else:
        value = raw.try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"Malformed {kind.simpleString()} in column {name} of {table}: "), raw))
    return F.when(raw.isNotNull() & value.isNull(), bad.cast(kind)).otherwise(value).alias(name)


def _columns(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """The text columns of Spark's own CSV reader, by header name."""
    return (spark.read.option("header", True).option("inferSchema", False).option("mode", "FAILFAST")
                 .option("multiLine", multi_line).options(**QUOTING)
                 .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _split_columns(spark: SparkSession, path: str, table: str, ordinal: str | None) -> DataFrame:
    """The same columns, read by many tasks a file whatever its quoted line breaks."""
    found = records.layout(spark, path)
    if found.all_whole and not ordinal:
        return _columns(spark, path, False)
    names = _columns(spark, path, True).columns
    each = records.records(found)
    records.check_headers(each, path, table)
    text = ", ".join(f"c{i} STRING" for i in range(len(names)))
    parsed = F.from_csv("record", text, {"mode": "FAILFAST", "multiLine": "true", **QUOTING,
                                         "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    extra = [records.ordinal().alias(ordinal)] if ordinal else []
    rows = each.where("number > 0").select(parsed.alias("r"), *extra)
    return rows.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)], *[F.col(f"`{ordinal}`") for _ in extra])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, table: str | None = None,
             date_format: str = "yyyy-MM-dd", extra_columns: bool = False, multi_line: bool | None = None,
             ordinal: str | None = None) -> DataFrame:
    """Typed CSV scan by header name; a missing input or column names its table.

    ``extra_columns`` keeps columns that the schema does not name, as text behind
    the others. By default one pass over the lines finds out where records may be
    cut, so that a large file is read by many tasks with or without quoted line
    breaks (a file that cannot be cut safely is refused). ``multi_line=True``
    reads each file as a whole in one task, ``False`` takes every line as a record
    without looking. ``ordinal`` names an added column with the place of the row in its source:
    files by name, records in file order, the same under any partitioning.
    """
    table = table or "table"
    if ordinal and multi_line is not None:
        raise ValueError("ordinal needs the record-safe reading (multi_line=None)")
    try:
        df = _split_columns(spark, path, table, ordinal) if multi_line is None else _columns(spark, path, multi_line)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"Missing input file for {table}: {path}") from exc
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            raise ValueError(f"No header in the input of {table}: {path}") from exc
        raise
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"Missing columns in the input of {table}: {', '.join(missing)} ({path})")
    rest = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames() and (extra_columns or c == ordinal)]
    return df.select(*[_typed(f.name, f.dataType, date_format, table) for f in schema.fields], *rest)


def _parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*[f"`{c}`" for c in schema.fieldNames()])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows in force of a loaded Parquet table with its declared schema (so partition
    values are typed by the schema, never inferred from directory names) in schema order
    (partition columns would otherwise come last)."""
    return _parquet(spark, publish.resolve(spark, path), schema)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail early when a required selection is empty (e.g. no Won deals)."""
    if df.isEmpty():
        raise ValueError(f"No rows found for {what}")
    return df


def load_raw(spark: SparkSession, plan: Sequence[LoadStep], out_dir: str | None = None,
             database: str | None = None, ordinal: str | None = None, verify: bool = False) -> dict[str, DataFrame]:
    """L1: typed load of every planned table; with ``out_dir``, full-refresh Parquet
    write of all tables (S8) and the returned frames read the written tables.

    The refresh is atomic: every table is written into a new generation, its content digest
    is taken, the steps' keys and references are checked, and only then one
    pointer is replaced (see ``publish``); a load that fails leaves the old tables
    readable. ``verify`` reads the sources once more and compares their digests with
    those of the written tables. ``ordinal`` adds a column of that name with each
    row's place in its source.

    With ``database`` the tables are also registered in the catalog (files under
    ``out_dir``), which is what lets Spark use a step's ``bucket_by`` when reading:
    ``<database>.<table>`` is a view of the generation in force.
    """
    if database and not out_dir:
        raise ValueError("a catalog load needs out_dir for the table files")
    sources = _together(spark, plan, lambda s: read_csv(spark, s.path, s.schema, s.table, multi_line=s.multi_line, ordinal=ordinal))
    if not out_dir:
        return sources
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    generation = publish.new_generation()
    target = {s.table: f"{out_dir}/{s.table}/{generation}" for s in plan}
    catalog = lambda table, g: f"`{database}`.`{table}__{g.replace('-', '_')}`"

    def checked(step: LoadStep) -> tuple[DataFrame, dict]:
        table = _write(spark, step, sources[step.table], target[step.table], database and catalog(step.table, generation))
        done = digest(table).head()
        if verify and tuple(digest(sources[step.table]).head()) != tuple(done):
            raise IOError(f"The written rows of {step.table} differ from those of {step.path}")
        if step.key:
            publish.check_key(table, step.table, step.key)
        return table, {"generation": generation, "rows": done["rows"], "digest": done["digest"]}

    try:
        written = _together(spark, plan, checked)
        tables, entries = ({t: w[k] for t, w in written.items()} for k in (0, 1))
        for step in plan:
            for ref in step.references:
                if ref.table not in tables:
                    raise ValueError(f"{step.table} refers to {ref.table}, which the load does not hold")
                publish.check_reference(tables[step.table], step.table, ref, tables[ref.table])
    except BaseException:
        for step in plan:
            if database:
                spark.sql(f"DROP TABLE IF EXISTS {catalog(step.table, generation)}")
            publish.remove(spark, target[step.table])
        raise
    gone = publish.switch(spark, out_dir, entries)
    if database:
        for step in plan:
            if not any(v.name == step.table and v.tableType == "VIEW" for v in spark.catalog.listTables(database)):
                spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{step.table}`")  # of a layout without generations
            spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{step.table}` AS SELECT * FROM {catalog(step.table, generation)}")
        for table, old in gone:
            spark.sql(f"DROP TABLE IF EXISTS {catalog(table, old)}")
    views.renew(spark, out_dir)
    return tables


def _together(spark: SparkSession, plan: Sequence[LoadStep], work: Callable) -> dict:
    """``work`` of every step, by table: the tables do not depend on each other, so their jobs run side by side.

    The first failure is raised after all have ended.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(len(plan), 8))) as pool:
        running = {s.table: pool.submit(inheritable_thread_target(spark)(work), s) for s in plan}
    return {table: r.result() for table, r in running.items()}


def _write(spark: SparkSession, step: LoadStep, df: DataFrame, target: str, name: str | None) -> DataFrame:
    """Write one table into its generation and return a frame that reads it."""
    schema = df.schema
    if step.partition_by:
        # one file per stage and about an advisory partition size, instead of one per task and stage;
        # AQE splits the rebalanced partitions of a large stage
        df = df.hint("rebalance", *step.partition_by)
    writer = df.write.partitionBy(*step.partition_by)
    if not name:
        writer.parquet(target)
        return _parquet(spark, target, schema)
    if step.bucket_by:
        n, cols = step.bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    writer.option("path", target).saveAsTable(name)
    return spark.table(name).select(*[f"`{c}`" for c in schema.fieldNames()])


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header and no index column; a directory of part files.
    Values are written as they are (Spark's writer would otherwise strip
    leading and trailing spaces)."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").options(**QUOTING)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


FACT_SIZED = frozenset({"vw_pipeline_summary"})


def export_marts(marts: Mapping[str, DataFrame], out_dir: str, single_file: bool = False) -> dict[str, str]:
    """One CSV directory per mart under ``out_dir``; returns mart -> path.

    ``single_file`` applies to the aggregated marts; the summary has a row per
    deal and always stays a directory of part files.
    """
    paths = {}
    for name, df in marts.items():
        path = os.path.join(out_dir, name)
        write_csv(df, path, single_file and name not in FACT_SIZED)
        paths[name] = path
    return paths


def read_marts(spark: SparkSession, marts: Mapping[str, DataFrame], paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The exported files of each mart, read back with the mart's own types."""
    return {name: read_csv(spark, paths[name], df.schema, name) for name, df in marts.items()}


def check_export(spark: SparkSession, marts: Mapping[str, DataFrame], paths: Mapping[str, str]) -> DataFrame:
    """(mart, expected_rows, actual_rows, same_content): the exported files against the marts, by content digest.

    Empty texts and nulls are the same in CSV (S7), so they are here.
    """
    return reconcile(dict(marts), read_marts(spark, marts, paths), "mart", empty_as_null=True)


def write_raw_csv(tables: Mapping[str, DataFrame], raw_dir: str, processed_dir: str) -> None:
    """Write role tables where ``default_plan`` expects them (round-trip tests, bench)."""
    for name, df in tables.items():
        base = processed_dir if name == "subscriptions" else raw_dir
        write_csv(df, f"{base}/{name}.csv")
