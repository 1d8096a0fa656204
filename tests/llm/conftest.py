import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, score string, removed int, before string"


def documents(spark, texts, source=lambda i: f"s{(i or 0) % 2}", lang=lambda i: "en"):
    """Documents with extra columns whose names operators use inside."""
    rows = [(i, t, lang(i), source(i), len(t or ""), "x", "y", 1, "z") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def make(spark):
    return lambda texts, **how: documents(spark, list(texts.items()) if isinstance(texts, dict) else texts, **how)
