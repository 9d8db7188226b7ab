"""Quality rules with adaptive thresholds from mergeable quantile sketches (built-in functions only).

Base measures of a text: words are runs of characters other than the six
ASCII white-space characters; see ``measures`` for the columns. Two fixed base
rules come first (fewer than 50 words; more than half of the words in repeated
three-word windows).

Every other rule has no fixed cutoff. Each measured ratio is an integer, and
its distribution per (lang, source) is kept as a relational quantile sketch:
one count per value bucket, where a bucket keeps the six leading binary digits
of the value (relative error below 1/32, at most 32 * 59 + 64 buckets a
group, whatever the number of rows). A text counts once in its (lang, source),
so a group of copies cannot move a cutoff: rows are first grouped by the hash of
their text and their measures, with partial aggregation. Sketches merge by adding
counts; merging also gives the sketch of a language and of all rows,
used for groups of fewer than ``min_group`` texts. Counts are exact and do not
depend on the partitioning, so the verdicts are reproducible.

A rule's cutoff for a group is the sketch's median plus ``reach``
times the distance from lower quartile to median, but at least ``slack`` above
the median, so that a group whose values hardly vary is not cut at its own
noise. Both quartiles lie on the clean side: junk moves neither as long as it
is less than half of a group's texts. The cutoffs are stored and joined to the measured rows by (lang,
source); Catalyst broadcasts them by their size in bytes, otherwise the join
is a shuffle join of the measured rows whose hot keys AQE splits.

Defined cases: a null text has no words and fails the base rules, as does an
empty one; null lang or source is a group of its own; repeated rows count
once and get equal verdicts; an empty table gives an empty result; columns
with clashing names are kept as they are in ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import SPACES, fresh, stored

_POSITION_BITS = 24  # of a window's sort key; the other 40 bits are its hash
MIN_WORDS, REPEAT_PERCENT = 50, 50  # base rules of the contract


@dataclass(frozen=True)
class Rule:
    """An integer ratio of a text and how far above its group's median it may lie."""
    name: str
    top: str
    bottom: str
    scale: int
    slack: int


RULES = (
    Rule("symbols", "n_symbols", "word_chars", 1000, 30),
    Rule("word_length", "word_chars", "n_words", 100, 250),
    Rule("dup_lines", "n_dup_lines", "n_lines", 1000, 500),
    Rule("repeats", "n_repeat_words", "n_words", 1000, 450),
    Rule("capitals", "n_capitals", "word_chars", 1000, 300),
)
REACH, MIN_GROUP = 4, 200
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the base measures of ``text_col`` (all long).

    n_words, word_chars (code points in words), n_symbols (characters of #*$%&|<>), n_lines and n_dup_lines
    (\\n-split lines that hold a word; those equal to an earlier one), n_repeat_words (words inside three-word
    windows that occur twice or more in the text), n_capitals (upper-case letters).
    """
    text, words, lines, runs, again = fresh(docs, "text_", "words_", "lines_", "runs_", "again_")
    d = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    d = d.withColumns({
        words: F.array_remove(F.split(F.col(text), SPACES + "+"), ""),
        lines: F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
    })
    # Windows that may repeat: their hashes, with the position in the low bits, sorted as plain longs; neighbours
    # with equal hash bits are candidates. Longer texts than the position bits allow take every window.
    count = F.greatest(F.size(words) - 2, F.lit(0))
    word = lambda i, k: F.get(F.col(words), i + k)
    hashed = F.transform(F.slice(F.col(words), F.lit(1), count), lambda x, i: F.shiftleft(
        F.xxhash64(x, word(i, 1), word(i, 2)), _POSITION_BITS).bitwiseOR(i.cast("long")))
    d = d.withColumn(runs, F.when(count < (1 << _POSITION_BITS), F.sort_array(hashed)))
    same = lambda x, i, k: F.shiftrightunsigned(x.bitwiseXOR(F.get(F.col(runs), i + k)), _POSITION_BITS) == 0
    at = F.transform(F.filter(F.col(runs), lambda x, i: same(x, i, -1) | same(x, i, 1)),
                     lambda x: x.bitwiseAND((1 << _POSITION_BITS) - 1).cast("int"))
    d = d.withColumn(again, F.coalesce(at, F.sequence(F.lit(0), count - 1)))
    # candidates are compared as words, so that hash collisions do not count
    window = F.transform(F.col(again), lambda i: F.struct(F.concat_ws(" ", word(i, 0), word(i, 1), word(i, 2)).alias("w"), i.alias("i")))
    d = d.withColumn(runs, F.sort_array(window))
    near = lambda x, i, k: x["w"] == F.get(F.col(runs), i + k)["w"]
    d = d.withColumn(again, F.filter(F.col(runs), lambda x, i: near(x, i, -1) | near(x, i, 1)))
    covered = F.array_distinct(F.flatten(F.transform(F.col(again), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    left = lambda pattern: F.length(F.regexp_replace(F.col(text), pattern, "")).cast("long")
    size = F.length(text).cast("long")
    return d.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(F.col(words), "")).cast("long"),
        "n_symbols": size - left("[#*$%&|<>]+"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.size(covered).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_capitals": size - left("\\p{Lu}+"),
    }).drop(text, words, lines, runs, again)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def ratio(rule: Rule) -> Column:
    """The rule's integer ratio; null where its denominator is zero (such a row cannot break the rule)."""
    return F.when(F.col(rule.bottom) > 0, F.call_function("div", F.lit(rule.scale) * F.col(rule.top), F.col(rule.bottom)))


def bucket(value: Column) -> Column:
    """The value with all but its six leading binary digits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return value - value % step


def sketches(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(lang, source, rule, value, n): the bucket counts per language and source, over rows that pass the base rules.

    ``measured`` should be a stored table: the measures would otherwise be computed once per use.
    """
    each = F.inline(F.array(*[F.struct(F.lit(r.name).alias("rule"), ratio(r).alias("v")) for r in rules]))
    rows = measured.where(~base_failed()).select("lang", "source", each).where("v is not null")
    return rows.groupBy("lang", "source", "rule", bucket(F.col("v")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def distinct_texts(measured: DataFrame) -> DataFrame:
    """One row for each text of a (lang, source) that passes the base rules; ``measured`` has the texts' hash as ``print``."""
    return measured.where(~base_failed()).groupBy("lang", "source", "print", *MEASURES).agg(F.count(F.lit(1)).alias("copies"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups, by adding counts."""
    return sketch.groupBy(*keys, "rule", "value").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, rule, total, q25, q50): the smallest bucket that at least a quarter / half of the texts do not exceed."""
    group = Window.partitionBy(*keys, "rule")
    run = sketch.withColumns({"up": F.sum("n").over(group.orderBy("value")), "total": F.sum("n").over(group)})
    return run.groupBy(*keys, "rule").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("up") >= F.col("total"), F.col("value"))).alias("q25"),
        F.min(F.when(2 * F.col("up") >= F.col("total"), F.col("value"))).alias("q50"))


def cutoffs(sketch: DataFrame, rules: tuple[Rule, ...] = RULES, reach: int = REACH, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, one cutoff column per rule), from the finest group that has ``min_group`` texts."""
    fine = quartiles(sketch, "lang", "source")
    lang = quartiles(merged(sketch, "lang"), "lang").select(
        F.col("lang").alias("l"), F.col("rule").alias("r"), *[F.col(c).alias(f"l_{c}") for c in ("total", "q25", "q50")])
    every = quartiles(merged(sketch)).select(F.col("rule").alias("r0"), F.col("q25").alias("e_q25"), F.col("q50").alias("e_q50"))
    met = fine.join(lang, fine["lang"].eqNullSafe(F.col("l")) & (F.col("rule") == F.col("r")), "left") \
        .join(every, F.col("rule") == F.col("r0"), "left")

    def chosen(q: str) -> Column:
        return F.when(F.col("total") >= min_group, F.col(q)).when(F.col("l_total") >= min_group, F.col(f"l_{q}")).otherwise(F.col(f"e_{q}"))

    slack = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.slack))])[F.col("rule")]
    top = chosen("q50") + F.greatest(F.lit(reach) * (chosen("q50") - chosen("q25")), slack)
    return met.select("lang", "source", "rule", top.alias("top")).groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("top"))).alias(f"top_{r.name}") for r in rules])


def judged(measured: DataFrame, tops: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` plus base_failed, the broken adaptive rules and kept."""
    t = tops.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    met = measured.join(t, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    broken = F.filter(F.array(*[F.when(ratio(r) > F.col(f"top_{r.name}"), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return met.withColumns({"base_failed": base_failed(), "broken_rules": broken}) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)) \
        .drop("t_lang", "t_source", *[f"top_{r.name}" for r in rules])


def _print() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def quality(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(doc_id, lang, source, measures, base_failed, broken_rules, kept) for every row of ``docs``."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col("text"), F.col("lang"), F.col("source"))
    measured = stored(measures(narrow).withColumn("print", _print()).drop("text"), "measures")
    return judged(measured, stored(cutoffs(sketches(distinct_texts(measured)), **options), "cutoffs")).drop("print")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns (texts are measured once and not shuffled)."""
    row, = fresh(docs, "row_")
    packed = docs.select(F.struct(*docs.columns).alias(row), F.col("text"), F.col("lang"), F.col("source"))
    measured = stored(measures(packed).withColumn("print", _print()).drop("text"), "measured")
    tops = stored(cutoffs(sketches(distinct_texts(measured)), **options), "cutoffs")
    return judged(measured, tops).where("kept").select(f"{row}.*")
