import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from ledgerline.llm import decontam, pieces, quality, simhash, toxicity
from ledgerline.llm.queries import QUERIES
from llm.test_decontam import brute as brute_hits
from llm.test_simhash import brute_groups, brute_print
from test_oracle import _arrow, _rows

COLUMNS = {
    "op1_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op2_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                          "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op4_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op8_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op10_chat_formatting": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
                             "formatted_chars": "bigint"},
    "op11_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
                           "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op13_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
}


def test_all_operators_and_the_pipeline_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in pipeline.STAGES][2] == "SimHash near-dedup" and len(pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    kinds = dict(QUERIES[name](spark, SMALL).dtypes)
    assert {c: kinds[c] for c in COLUMNS[name]} == COLUMNS[name]


@pytest.mark.parametrize("name", ["op1_warc", "op3_quality_rules", "op7_decontamination", "op10_chat_formatting", "op11_periodic_runs",
                                  "op12_lexical_search", "op13_nearest_neighbours"])
def test_matches_the_statement(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    assert _rows(QUERIES[name](spark, SMALL).toArrow()) == _rows(_arrow(con.sql(entry.oracle_sql()[name])))


def test_rows_of_the_pipeline_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r["doc_id"] for r in quality.quality(docs).collect() if r["kept"]}
    rows = [r for r in docs.collect() if r["doc_id"] in kept]
    model = toxicity.fit(spark.createDataFrame(rows, docs.schema), spark.read.parquet(f"{SMALL}/labels.parquet"))
    score, _ = toxicity.score_texts([r["text"] for r in rows], model, toxicity._Scores(model))
    rows = [r for r, s in zip(rows, score) if s < 0.5]
    groups = brute_groups([(r["doc_id"], brute_print(r["text"])) for r in rows])
    rows = [r for r, g in zip(rows, groups) if r["doc_id"] == g]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hit = {h[0] for h in brute_hits([(r["doc_id"], r["text"]) for r in rows], items) if h[-1]}
    want = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] not in hit}
    got = pipeline.run(spark, SMALL).collect()
    vocabulary = pieces.load_vocabulary()
    assert hit and {r["doc_id"]: pieces.decode(r["ids"], vocabulary) for r in got} == want
    assert all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_stages_take_edge_rows_and_empty_tables(spark, edge_docs, no_docs):
    for k, (_, stage) in enumerate(pipeline.STAGES):
        for docs in (edge_docs, no_docs):
            out = stage(spark, docs, SMALL)
            assert out.count() <= docs.count()
            if k < 4:
                assert out.columns == docs.columns
    assert decontam and simhash
