"""Order-free digests of the rows of a table: equal content, equal digest, however the rows are stored or spread.

A row becomes one text: for each column, in the given order, ``N`` for null or
``V<length>:<value>``, so that no two rows share a text. The md5 of that text
gives two integers of 60 bits; the digest of a table is its row count and the
exact sums of both integers. Sums merge, so partial aggregation leaves one row
a task to shuffle; repeated rows count each time.

Values are written as plain text: dates as yyyy-MM-dd, timestamps in UTC,
decimals with their scale, whole numbers and booleans as they are, floating
numbers with six decimals. Any engine with md5 can compute the same (see
``ledgerline.oracle.digest``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = 15  # hexadecimal digits of each of the two numbers


def _text(field: T.StructField, empty_as_null: bool) -> Column:
    c = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.cast("decimal(38,6)").cast("string")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise ValueError(f"column {field.name}: {kind.simpleString()} has no plain text form")
    if isinstance(kind, T.StringType) and empty_as_null:
        return F.nullif(c, F.lit(""))
    return c.cast("string")


def row_text(schema: T.StructType, empty_as_null: bool = False) -> Column:
    """The text of a row with the columns of ``schema``, in their order."""
    text = [_text(f, empty_as_null) for f in schema.fields]
    parts = [F.coalesce(F.concat(F.lit("V"), F.length(t).cast("string"), F.lit(":"), t), F.lit("N")) for t in text]
    return F.concat(*parts) if parts else F.lit("")


def digest_columns(schema: T.StructType, empty_as_null: bool = False) -> list[Column]:
    """Aggregates ``rows`` and ``digest`` over rows with these columns."""
    text = F.md5(row_text(schema, empty_as_null).cast("binary"))
    part = lambda k: F.conv(F.substring(text, 1 + k * _DIGITS, _DIGITS), 16, 10).cast("decimal(38,0)")
    total = lambda k: F.coalesce(F.sum(part(k)), F.lit(0).cast("decimal(38,0)")).cast("string")
    return [F.count(F.lit(1)).alias("rows"), F.concat(total(0), F.lit("-"), total(1)).alias("digest")]


def digest(df: DataFrame, columns: list[str] | None = None, empty_as_null: bool = False) -> DataFrame:
    """One row (rows, digest) for ``df``, over ``columns`` in that order (all of its own by default).

    ``empty_as_null`` takes empty texts as null, as files do that cannot tell them apart (CSV).
    """
    some = df.select(*[f"`{c}`" for c in columns]) if columns else df
    return some.agg(*digest_columns(some.schema, empty_as_null))


def digests(tables: dict[str, DataFrame], label: str = "table_name", empty_as_null: bool = False) -> DataFrame:
    """(label, rows, digest) of several tables."""
    out = None
    for name, df in tables.items():
        one = digest(df, empty_as_null=empty_as_null).select(F.lit(name).alias(label), "rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out


def reconcile(expected: dict[str, DataFrame], actual: dict[str, DataFrame], label: str = "table_name", empty_as_null: bool = False) -> DataFrame:
    """(label, expected_rows, actual_rows, same_content): two sets of tables by their digests."""
    a = digests(expected, label, empty_as_null).withColumnsRenamed({"rows": "expected_rows", "digest": "d1"})
    b = digests({n: actual[n].select(*[f"`{c}`" for c in df.columns]) for n, df in expected.items()}, label, empty_as_null) \
        .withColumnsRenamed({"rows": "actual_rows", "digest": "d2"})
    same = (F.col("expected_rows") == F.col("actual_rows")) & (F.col("d1") == F.col("d2"))
    return a.join(b, label).select(label, "expected_rows", "actual_rows", same.alias("same_content"))
