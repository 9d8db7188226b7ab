"""The registered queries of the training-data operators: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import chat, decontam, html_text, langid, lexical, nearest, pieces, quality, runs, sharding, simhash, toxicity, warc
from ledgerline.llm.common import drop_at_exit, id_remainder, scratch_path, ship_package, table

Query = Callable[[SparkSession, str], DataFrame]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.archive(table(spark, sf_dir, "pages"), path)
    drop_at_exit(spark, path)
    back = warc.read_warc(spark, path, ["record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_length", "payload"])
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    # of a response the payload itself is measured, of a revisit what its headers say
    own = F.col("record_type") == "response"
    return back.select(
        page("record_id").alias("page_id"), F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(own, warc.sha1_base32(F.col("payload"))).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"), F.col("target_uri").alias("url"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.tag(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", (id_remainder("doc_id", toxicity.HELD_OUT_MOD) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 4) == 2
    return langid.predict(docs, langid.fit(docs.where(~held_out)), ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "variant", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=40)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), ["page_id"])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_paths(chat.linear_nodes(rows.unionByName(more)))
    return chat.read_back(formatted.withColumnRenamed("tree", "conv_id"), ["conv_id"])


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return runs.digest(runs.periodic_runs(docs, ["doc_id"]))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.pmod("id", F.lit(nearest.QUERY_EVERY)) == 0)


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {name: _shipped(q) for name, q in {
    "op1_warc": op1,
    "op2_toxicity": op2,
    "op3_quality_rules": op3,
    "op4_language_id": op4,
    "op5_sentencepiece": op5,
    "op6_simhash": op6,
    "op7_decontamination": op7,
    "op8_sharding": op8,
    "op9_html_extraction": op9,
    "op10_chat_formatting": op10,
    "op11_periodic_runs": op11,
    "op12_lexical_search": op12,
    "op13_nearest_neighbours": op13,
}.items()}
