import pytest

from ledgerline.llm.common import ship_package

# nulls, empty and long texts, repeated rows, ties, no words, other scripts
EDGE_TEXTS = [None, "", " \n\t ", "one", "one two", "one two three", "one two three", "a b c a b c a b c", "x" * 200_000,
              "w " * 60_000, "É ß 日本語 \U0001F600 ▁ x▁y", "line\nline\nline\nother", "\r\n\x0b\x0c", "a\x00b", "... !!! ###"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge texts twice (repeated rows), null ids and attributes, and columns whose names clash with results."""
    rows = [(None if i == 3 else i, t, [None, "en", "fr"][i % 3], [None, "a", "b"][i % 3], len(t or ""), 7, "x", 1.5, [1], "k")
            for i, t in enumerate(EDGE_TEXTS)]
    rows += rows[1:4]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, fp long, kept string, score double, hits array<int>, row string")


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return edge_docs.where("false")


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
