"""Files, sinks, streaming, and the whole pipeline with plain-text files as documents."""

import datetime as dt
import zipfile

from pyspark.sql import functions as F

from lipiflow.config import Config, from_environment
from lipiflow.operators import entities
from lipiflow.plans.pipeline import Pipeline
from lipiflow.sources import backends, files, sinks
from lipiflow.streaming import ingest

TEXT = "नाम: राम कुमार आयु: 25 वर्ष\fसीता देवी"


def folder(tmp_path, **texts):
    d = tmp_path / "in"
    d.mkdir(exist_ok=True)
    for name, text in texts.items():
        (d / f"{name}.txt").write_text(text, encoding="utf-8")
    return str(d)


def test_scan_and_pages(spark, tmp_path):
    listed = files.scan(spark, folder(tmp_path, a=TEXT, b=" "), ".TXT", content=True)
    assert {r.filename for r in listed.collect()} == {"a.txt", "b.txt"}
    rows = backends.extract_pages(listed, (backends.PLAIN,)).orderBy("page_number").collect()
    assert [(r.page_number, r.confidence, r.extraction_method) for r in rows] == [(1, 0.95, "direct_text"), (2, 0.95, "direct_text")]
    ids = listed.select("file_id").union(spark.createDataFrame([("x",)], "file_id string"))
    assert sorted(r.ok for r in files.fetched(ids, listed).collect()) == [False, True, True]


def test_ledger_file(spark, tmp_path):
    assert files.read_ledger(spark, str(tmp_path / "no.json")).count() == 0
    p = tmp_path / "l.json"
    p.write_text('{"id1": {"filename": "a", "processing_status": "failed", "processing_attempts": 2, "first_seen": "2024-01-01T00:00:00"}}')
    r = files.read_ledger(spark, str(p)).first()
    assert (r.file_id, r.processing_status, r.processing_attempts, r.first_seen) == ("id1", "failed", 2, dt.datetime(2024, 1, 1))


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([("f", 1, 'नाम: राम "कुमार"')], "file_id string, page_number int, text string")
    rows = entities.entity_rows(entities.extract(pages), F.lit("a.pdf"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    sinks.write_csv(rows, str(tmp_path / "c"))
    assert next((tmp_path / "c").glob("part*")).read_bytes().startswith(b"\xef\xbb\xbfOriginal Filename,Page Number")
    back = sinks.read_csv(spark, str(tmp_path / "c"))
    check = sinks.validate_rows(back).first()
    assert check.valid and check.row_count == rows.count() and check.column_count == 12
    assert not sinks.validate_rows(back.drop("Page Number")).first().valid
    sinks.write_excel({"Extracted Data": rows, "Summary": rows}, str(tmp_path / "x.xlsx"))
    with zipfile.ZipFile(tmp_path / "x.xlsx") as z:
        assert "राम" in z.read("xl/worksheets/sheet1.xml").decode()


def test_stream_equals_batch(spark, tmp_path):
    d = folder(tmp_path, a=TEXT)
    got = str(tmp_path / "out")

    def cycle():
        pages = ingest.page_stream(ingest.file_stream(spark, d, "*.txt"), (backends.PLAIN,))
        ingest.start(ingest.entity_stream(pages), lambda df, n: df.write.mode("append").parquet(got), str(tmp_path / "ck")).awaitTermination()

    cycle()
    assert spark.read.parquet(got).count() == 2
    folder(tmp_path, b="गीता पटेल")
    cycle()
    batch = entities.extract(backends.extract_pages(files.scan(spark, d, ".txt", content=True), (backends.PLAIN,)))
    key = ["page_number", "cleaned_text", F.size("entities").alias("n")]
    assert sorted(map(tuple, spark.read.parquet(got).select(*key).collect())) == sorted(map(tuple, batch.select(*key).collect()))


def test_pipeline(spark, tmp_path):
    config = Config(input_folder=folder(tmp_path, a=TEXT, b=" ", c="12 34"), output_folder=str(tmp_path / "o"), ledger_path=str(tmp_path / "l"))
    p = Pipeline(spark, config, (backends.PLAIN,), suffix=".txt")
    t = dt.datetime(2024, 1, 1)
    first = p.run_cycle(t)
    assert (first["processed"], first["failed"], first["skipped"]) == (1, 2, 0)
    again = p.run_cycle(t + dt.timedelta(hours=1))
    assert (again["processed"], again["failed"], again["skipped"]) == (0, 2, 1)
    folder(tmp_path, a=TEXT + " और")
    assert p.run_cycle(t + dt.timedelta(hours=2))["processed"] == 1
    state = {r.filename: (r.processing_status, r.processing_attempts) for r in p.ledger().collect()}
    assert state == {"a.txt": ("completed", 2), "b.txt": ("failed", 3), "c.txt": ("failed", 3)}
    assert p.status()["runs_count"] == 3 and {e["error_message"] for e in p.recent_errors()} == {"No text could be extracted", "No entities to write"}
    assert p.maintain(t + dt.timedelta(days=1)) == 0
    p.report(str(tmp_path / "r"))


def test_config(tmp_path):
    import pytest

    with pytest.raises(ValueError, match="INPUT_FOLDER is required; OUTPUT_FOLDER is required"):
        Config()
    c = from_environment({"INPUT_FOLDER": "a", "OUTPUT_FOLDER": "b", "MAX_RETRIES": "5"})
    assert c.max_retries == 5 and c.csv_encoding == "utf-8-sig" and c.get("nothing", 1) == 1
    with pytest.raises(ValueError):
        c.update(polling_interval_seconds=0)


def test_table_preview():
    assert backends.first_table([["a\nb", None], ["x" * 60, ""], [], ["dropped"]]) == [["a b", ""], ["x" * 50 + "...", ""], []]
