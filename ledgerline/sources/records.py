"""Delimited files read in record-safe splits: many tasks a file, also with line breaks inside quotes.

Spark cuts a text file at line ends, but a line end inside quotes does not end
a record. Whether a line begins inside quotes follows from the number of
quotes before it: a doubled quote counts twice, so only the parity matters.
Each split of a file has a parity of its own, and a running sum over the splits
of a file (one short row each) says how every split begins:

1. One pass over the lines says whether all of them are whole records. If so, the
   file is read by Spark's own CSV reader, split as it likes.
2. Otherwise a table with the rows and the parity of each split is made, the lines of a split are put in order, each gets its record's
   number, and the lines of a record are joined where they are. Only the records
   that cross a split border, one a border at most, are brought together by file and
   record number.

Every record that was put together is checked: quotes may only stand around a whole
field or doubled inside it. A file with other quotes, or with bare carriage
returns as line ends, is refused with an error, never torn; such a file has to be
read as a whole (``multi_line=True``).

Record numbers count from 0, the header, in the order of the file, whatever the
splits and partitions; ``ordinal`` uses them as a stable place of each row.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

BROADCAST_SPLITS = 200_000  # rows of the split table that are broadcast; beyond that it is joined by a shuffle
FILE_SHIFT = 40  # bits of an ordinal that count records of one file
# a field is quoted as a whole, or holds no quote, separator or line end; possessive, so long fields need no deep stack
_FIELD = '(?:"(?:[^"]++|"")*+"|[^",\\r\\n]*+)'
_RECORD = f"^{_FIELD}(?:,{_FIELD})*+$"


class Layout:
    """The lines of a path, and what each split of its files holds."""

    def __init__(self, lines: DataFrame, all_whole: bool):
        self.lines = lines  # file, split, place, line
        self.all_whole = all_whole  # every line is a record of its own

    @cached_property
    def splits(self) -> DataFrame:
        """(file, split, first, n, odd): one row each, checkpointed; only made when it is needed."""
        ensure_checkpoint_dir(self.lines.sparkSession)
        return self.lines.groupBy("file", "split").agg(
            F.min("place").alias("first"), F.count(F.lit(1)).alias("n"),
            F.pmod(F.sum(_quotes(F.col("line"))), F.lit(2)).alias("odd")).checkpoint()

    @cached_property
    def n_splits(self) -> int:
        return self.splits.count()


def _quotes(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit('"')))


def _whole(c: Column) -> Column:
    """Whether a line (without its carriage return) is a record of its own."""
    plain = (F.instr(c, '"') == 0) & (F.instr(c, "\r") == 0)
    return plain | F.when(~plain, c.rlike(_RECORD)).otherwise(False)


def _unended(c: Column) -> Column:
    """A line without the carriage return before its line feed."""
    return F.when(F.endswith(c, F.lit("\r")), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)


def layout(spark: SparkSession, path: str) -> Layout:
    """One pass over the lines of ``path``; a task sends one value."""
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                       F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
    whole = raw.agg(F.min(_whole(_unended(F.col("value"))))).head()[0]
    return Layout(lines, whole is not False)


def _by_split(rows: DataFrame, splits: DataFrame, n_splits: int) -> DataFrame:
    return rows.join(F.broadcast(splits) if n_splits <= BROADCAST_SPLITS else splits, ["file", "split"])


def records(found: Layout) -> DataFrame:
    """(file, file_no, number, record): every record as one text; blank records are left out but counted."""
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(in_file), F.lit(0))
    numbered = found.splits.withColumn("file_no", F.dense_rank().over(Window.orderBy("file")) - 1)  # one row a split
    if found.all_whole:
        begin = numbered.select("file", "split", "file_no", "first", before("n").alias("base"))
        out = _by_split(found.lines, begin, found.n_splits).select(
            "file", "file_no", (F.col("base") + F.col("place") - F.col("first")).alias("number"), _unended(F.col("line")).alias("record"))
        return out.where(F.trim("record") != "")
    parity = numbered.select("file", "split", "file_no", F.pmod(before("odd"), F.lit(2)).alias("open"), F.col("odd").alias("turned"))
    in_split = Window.partitionBy("file", "split").orderBy("place")
    earlier = in_split.rowsBetween(Window.unboundedPreceding, -1)

    def marked(rows: DataFrame, at: DataFrame) -> DataFrame:
        """Whether each line begins a record (``starts``), and the records begun in its split up to it (``rec``)."""
        m = _by_split(rows, at, found.n_splits).withColumn("odd", F.pmod(_quotes(F.col("line")), F.lit(2)))
        m = m.withColumn("starts", 1 - F.pmod(F.col("open") + F.coalesce(F.sum("odd").over(earlier), F.lit(0)), F.lit(2)))
        return m.withColumn("rec", F.sum("starts").over(in_split))

    # records begun in each split: a row a split again, from a pass that moves no text
    quote = F.when(F.pmod(_quotes(F.col("line")), F.lit(2)) == 1, F.lit('"')).otherwise(F.lit(""))
    begun = marked(found.lines.withColumn("line", quote), parity).groupBy("file", "split").agg(F.sum("starts").alias("begun")).checkpoint()
    base = parity.join(begun.withColumn("base", before("begun")), ["file", "split"])
    each = marked(found.lines, base).withColumn("number", F.col("base") + F.col("rec") - 1)
    left_open = (F.pmod(F.col("open") + F.col("turned"), F.lit(2)) == 1) & (F.col("rec") == F.col("begun"))
    crosses = (F.col("rec") == 0) | left_open
    of_record = Window.partitionBy("file", "split", "rec").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = each.where(~crosses).withColumn("record", F.array_join(F.collect_list("line").over(of_record), "\n")).where("starts = 1")
    lines = F.array_sort(F.collect_list(F.struct("split", "place", "line")))
    over = each.where(crosses).groupBy("file", "file_no", "number").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("record"))
    whole = inside.select("file", "file_no", "number", "record").unionByName(over)
    whole = whole.withColumn("record", _unended(F.col("record"))).where(F.trim("record") != "")
    refused = F.raise_error(F.concat(F.lit("Quotes that do not enclose a whole field, or bare carriage returns; read the file with multi_line=True: "),
                                     F.col("file"), F.lit(" record "), F.col("number").cast("string")))
    return whole.withColumn("record", F.when(_whole(F.col("record")), F.col("record")).otherwise(refused.cast("string")))


def ordinal() -> Column:
    """A row's stable place over all files of a path: files by name, records in the order of their file."""
    return F.shiftleft(F.col("file_no").cast("long"), FILE_SHIFT).bitwiseOR(F.col("number"))


def check_headers(found: DataFrame, path: str, table: str) -> None:
    """All files of a path must begin with the same header."""
    heads = found.where("number = 0").select("record").distinct().limit(2).collect()
    if len(heads) > 1:
        raise ValueError(f"The files of {table} differ in their header ({path})")
