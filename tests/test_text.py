"""Text functions on literal rows, with results worked out by hand."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lipiflow import lexicon as L
from lipiflow.functions import text as T


def values(spark, rows, *cols):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    cols = [c(F.col("x")) for c in cols]
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).collect()]


def test_clean(spark):
    cases = {
        "राम  कुमार!@#$%^&*()  शर्मा   ।।। ": "राम कुमार () शर्मा ।।।",
        "नाम    :    सीता     देवी     ।।": "नाम सीता देवी ।।",
        "!!!   गीता   ###   पटेल   $$$ ": "गीता पटेल",
        "  आयु: 25 वर्ष   ।।।": "आयु 25 वर्ष ।।।",
        "<<>>  मोहन लाल {{}} गुप्ता  <<<": "मोहन लाल गुप्ता",
        "राम । श्याम": "राम श्याम",
        "राम । । श्याम": "राम । श्याम",
        "राम श्याम": "राम श्याम",
        "": "",
        "   ": "",
        None: "",
    }
    assert values(spark, list(cases), T.clean_text) == list(cases.values())


def test_transliterate(spark):
    cases = {"राम": "Ram", "श्याम": "Shyam", "कृष्ण": "Krishna", "सीता": "Sita", "राम कुमार शर्मा": "Ram Kumara Sharma", "": "", None: ""}
    assert values(spark, list(cases), T.transliterate) == list(cases.values())


def test_names(spark):
    cases = {"राम कुमार": True, "प्रिया शर्मा": True, "": False, "का": False, "वर्ष महीना": False, "क ख": False, "अ आ इ ई उ": False, "की के": False}
    assert values(spark, list(cases), T.valid_name) == list(cases.values())
    cases = {"Ram Kumar": True, "": False, "A": False, "A B C": False, "Ram123": False, "Aa Bb Cc Dd Ee": False, "x" * 21: False}
    assert values(spark, list(cases), T.looks_like_name) == list(cases.values())


def test_confidence(spark):
    cases = [("राम कुमार शर्मा", 1.0, 0.85), ("शर्मा", 0.85, 0.65), ("सीता देवी", 0.95, 0.75)]
    got = values(spark, [c[0] for c in cases], lambda x: T.name_confidence(x, "context"), lambda x: T.name_confidence(x, "pattern"))
    assert [tuple(round(v, 3) for v in g) for g in got] == [c[1:] for c in cases]


def test_similarity(spark):
    df = spark.createDataFrame([("ram", "ram", 1.0), ("ram", "sita", 1 / 6), ("", "ram", 0.0), ("age: 25", "age: 52", 1.0)], "a string, b string, s double")
    assert all(abs(r[0] - r[1]) < 1e-9 for r in df.select(T.similarity(F.col("a"), F.col("b")), "s").collect())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="रामश्यकुमा ।12/-नाम:", max_size=30), min_size=1, max_size=20))
def test_spans_slice_back(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    rows = df.select("x", F.explode(T.matches(F.col("x"), L.NAME)).alias("m")).collect()
    for r in rows:
        assert r.x[r.m.start : r.m.end] == r.m.text
    cleaned = df.select(T.clean_text(F.col("x")).alias("c")).collect()
    assert not any(ord(c) < 128 and c.isalpha() for r in cleaned for c in r.c)


@pytest.mark.parametrize("name,mime", [("a.csv", "text/csv"), ("b/c.PDF", "application/pdf"), ("d", "application/octet-stream")])
def test_mime(spark, name, mime):
    assert values(spark, [name], T.mime_type) == [mime]
