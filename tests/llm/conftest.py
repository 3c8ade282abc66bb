import pytest


@pytest.fixture
def docs(spark):
    """Documents with nulls, empty and repeated rows, a very long text, and columns that clash with internal names."""

    def make(texts, ids=None, extra=True):
        rows = [(i, t, "en", "s", len(t) if t else None) for i, t in zip(ids or range(len(texts)), texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        return df.selectExpr("*", "doc_id AS id", "'x' AS score", "1 AS node", "2 AS mask", "3 AS key") if extra else df

    return make


@pytest.fixture(scope="session")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    return P.path("word_bpe_49k.json")
