"""Extraction goldens, greedy de-duplication, validation and summaries."""

from pyspark.sql import functions as F

from lipiflow.operators import entities, extraction


def pages(spark, texts):
    return spark.createDataFrame([("f", i, t) for i, t in enumerate(texts, 1)], "file_id string, page_number int, text string")


def found(spark, text):
    rows = entities.extract(pages(spark, [text])).select(F.explode("entities").alias("e")).collect()
    return [(r.e.hindi_text, r.e.entity_type, r.e.position.start, r.e.position.end, round(r.e.confidence, 3)) for r in rows]


def test_goldens(spark):
    assert found(spark, "नाम: राम कुमार शर्मा आयु: 25 वर्ष पता: दिल्ली, भारत") == [("राम कुमार शर्मा आयु", "name", 0, 24, 0.9), ("आयु 25", "age", 20, 26, 0.9)]
    assert found(spark, "नाम: राम कुमार आयु: 25 वर्ष") == [("राम कुमार आयु", "name", 0, 18, 1.0), ("नाम राम कुमार आयु", "name", 0, 17, 0.7), ("आयु 25", "age", 14, 20, 0.9)]
    assert found(spark, "राम कुमार शर्मा") == [("शर्मा", "name", 4, 15, 0.85), ("राम कुमार शर्मा", "name", 0, 15, 0.85)]
    assert found(spark, "श्रीमती गीता") == [("मती गीता", "name", 0, 12, 0.95), ("श्रीमती गीता", "name", 0, 12, 0.85)]
    assert found(spark, "जन्म तिथि: 15/08/1998") == [("15/08/1998", "date", 10, 20, 0.95)]
    assert found(spark, "") == [] and found(spark, None) == []


def test_unique(spark):
    df = entities.extract(pages(spark, ["नाम: राम कुमार आयु: 25 वर्ष", "नाम: राम कुमार आयु: 52 वर्ष"]))
    kept = entities.file_entities(df).select(F.explode("entities").alias("e")).collect()
    assert [r.e.english_lowercase for r in kept] == ["ram kumara ayu", "age: 25"]
    first = entities.unique_across_pages(df, compact_to_first_page=True).orderBy("page_number").collect()
    assert [len(r.entities) for r in first] == [2, 0]
    apart = entities.unique_across_pages(df).orderBy("page_number").collect()
    assert [len(r.entities) for r in apart] == [2, 0]


def test_surer_one_wins(spark):
    e = "named_struct('hindi_text', '', 'english_text', '{0}', 'english_lowercase', lower('{0}'), 'entity_type', 'name', 'confidence', {1}D, 'page_number', 1, 'position', named_struct('start', 0, 'end', 0))"
    df = spark.range(1).select(F.expr(f"array({e.format('Ram Kumar', 0.7)}, {e.format('Sita Devi', 0.8)}, {e.format('Ram Kumar', 0.9)})").alias("entities"))
    kept = df.select(F.explode(entities.greedy_unique(F.col("entities"))).alias("e")).collect()
    assert [(r.e.english_text, r.e.confidence) for r in kept] == [("Sita Devi", 0.8), ("Ram Kumar", 0.9)]


def test_validation_and_summary(spark):
    df = entities.extract(pages(spark, ["नाम: राम कुमार आयु: 25 वर्ष", "", "12"]))
    rows = entities.validate(df, "page_number").orderBy("page_number").collect()
    assert [r.is_valid for r in rows] == [True, False, False] and rows[1].reason == "No entities extracted"
    s = entities.processing_summary(df).first()
    assert (s.total_pages, s.successful_pages, s.total_entities, s.total_names) == (3, 1, 3, 2)
    assert entities.processing_summary(df.filter("false")).first().total_pages == 0


def test_page_metrics_boundaries(spark):
    rows = [("a", 1, "x" * 10, 0.6), ("a", 2, "x" * 10, 0.6), ("b", 1, "x" * 9, 0.9), ("c", 1, "x" * 20, 0.6), ("c", 2, "  ", 0.6)]
    df = spark.createDataFrame(rows, "file_id string, page_number int, text string, confidence double")
    assert {r.file_id: r.valid for r in extraction.page_metrics(df, "file_id").collect()} == {"a": True, "b": False, "c": True}
    assert extraction.page_metrics(df.filter("false")).first().reason == "No pages extracted"


def test_hybrid(spark):
    cols = "file_id string, page_number int, text string, confidence double, extraction_method string"
    own = spark.createDataFrame([("f", 1, "long enough text", 0.9, "direct"), ("f", 2, "x", 0.9, "direct"), ("f", 3, "y", 0.9, "direct")], cols)
    ocr = spark.createDataFrame([("f", 2, "seen", 0.8, "ocr"), ("g", 1, "scan", 0.8, "ocr")], cols)
    rows = {(r.file_id, r.page_number): (r.text, r.extraction_method) for r in extraction.hybrid(own, ocr).collect()}
    assert rows == {("f", 1): ("long enough text", "direct"), ("f", 2): ("seen", "hybrid_ocr"), ("f", 3): ("y", "direct"), ("g", 1): ("scan", "hybrid_ocr")}
    rows = {(r.file_id, r.page_number) for r in extraction.hybrid(own, ocr, faithful=True).collect()}
    assert rows == {("f", 1), ("f", 2)}
