"""Corpus pipeline over ``documents``: quality rules, toxicity, near-duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and calls one operator of ``ledgerline.llm``;
its output is written as Parquet and read again as the next stage's ``docs``. The
first four stages return the columns of ``documents`` for the rows they keep; the
last one returns doc_id, lang, source, variant, n_tokens, ids and lossless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontam, pieces, quality, simhash, toxicity
from ledgerline.llm.common import ship_package, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the adaptive thresholds keep."""
    ship_package(spark)
    return quality.keep_good(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model scores below one half; it learns from the stage's input and ``labels``."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (three-word shingles, at most 3 differing bits): the smallest doc_id."""
    ship_package(spark)
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any occurrence of a benchmark window."""
    ship_package(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with seeded merge-dropout; ``lossless`` says that decoding gave the text back."""
    ship_package(spark)
    out = pieces.encode_texts(docs, ["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", "variant", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

# The conditional random field of the toxicity stage and merge-dropout cannot be expressed in SQL;
# tests hold run() against brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
