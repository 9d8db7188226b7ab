import numpy as np
import pytest
import sentencepiece
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import pieces as P
from llm.conftest import EDGE_TEXTS

VOCABULARY = P.load_vocabulary()
PLAIN, DROPPED = P.Encoder(VOCABULARY, 0.0), P.Encoder(VOCABULARY, 0.3)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=P.MODEL_PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80), st.integers(0, 2 ** 32 - 1))
def test_every_text_decodes_again(text, document):
    assert P.decode(DROPPED.encode(text, document).tolist(), VOCABULARY) == text
    assert P.decode(PLAIN.encode(text).tolist(), VOCABULARY) == text


def test_without_dropout_the_pieces_are_the_library_s(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    for t in texts + ["  a  b ", "x" * 300, "é\U0001F600\n\n\tq", " " * 70]:
        assert PLAIN.encode(t).tolist() == LIBRARY.encode(t)


def one_by_one(encoder, text, document):
    """Every chunk of a text merged alone through its own agenda."""
    chunks = encoder.cut(" " + text) if text else []
    keys = encoder.keys(document, len(chunks)).tolist()
    return [i for c, k in zip(chunks, keys) for i in encoder.alone(c, k)]


@pytest.mark.parametrize("dropout", [0.1, 0.3, 0.7, 1.0])
def test_many_chunks_at_once_equal_one_by_one(spark, dropout):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(15).collect()]
    texts += ["a" * 60 + " " + "a" * 61, "  x▁y \U0001F600 日本\n\n", "", "the the the"]
    encoder = P.Encoder(VOCABULARY, dropout)
    documents = [encoder.key(str(i)) for i in range(len(texts))]
    for _ in range(2):  # with an empty memory and with a full one
        got = encoder.encode_many(texts, documents)
        assert [g.tolist() for g in got] == [one_by_one(encoder, t, d) for t, d in zip(texts, documents)]


def test_the_memory_changes_no_result(monkeypatch):
    texts = [f"some words {i} in the northern countries " * 4 for i in range(60)]
    want = [P.Encoder(VOCABULARY, 0.3).encode(t, i).tolist() for i, t in enumerate(texts)]
    monkeypatch.setattr(P, "_REMEMBERED", 5)
    assert [g.tolist() for g in P.Encoder(VOCABULARY, 0.3).encode_many(texts, list(range(60)))] == want
    small = P.Encoder(VOCABULARY, 0.3)
    assert [small.encode(t, i).tolist() for i, t in enumerate(texts)] == want


def test_dropout_varies_by_document_and_repeats_by_seed(spark):
    docs = spark.createDataFrame([(i, "the weather in the northern countries") for i in range(40)], "doc_id long, text string")
    run = lambda seed: {r["doc_id"]: tuple(r["ids"]) for r in P.encode_texts(docs, ["doc_id"], seed=seed).collect()}
    one = run(1)
    assert len(set(one.values())) > 20
    assert one == run(1) != run(2)
    every = [P.Encoder(VOCABULARY, 1.0).encode("the weather").tolist()]
    assert len(every[0]) == len(" the weather")  # all candidates skipped: characters


def test_occurrences_in_one_text_differ():
    ids = P.Encoder(VOCABULARY, 0.3).encode_many(["countries"] * 400, list(range(400)))
    kinds = {tuple(x.tolist()) for x in ids}
    assert len(kinds) > 15
    many = P.Encoder(VOCABULARY, 0.3)
    one = many.encode(" ".join(["countries"] * 400), 7)
    words, at = set(), []
    for i in one.tolist():  # cut where a piece begins with the mark
        if many.vocabulary.raw[i].startswith(b" ") and at:
            words.add(tuple(at))
            at = []
        at.append(i)
    assert len(words) > 15
    share = sum(len(x) > len(PLAIN.encode("countries")) for x in ids) / len(ids)
    assert 0.2 < share < 0.95


def test_edge_rows(spark, edge_docs, no_docs):
    out = P.encode_texts(edge_docs, ["doc_id", "text"])
    rows = out.collect()
    assert len(rows) == len(EDGE_TEXTS) + 3 and all(r["lossless"] for r in rows)
    assert [r["ids"] for r in rows if r["text"] is None] == [None] and [r["ids"] for r in rows if r["text"] == ""][0] == []
    back = {(r["doc_id"], r["text"]) for r in P.decode_ids(out, ["doc_id"]).collect()}
    assert back == {(r["doc_id"], r["text"]) for r in rows}
    assert P.encode_texts(no_docs, ["doc_id"]).collect() == []
