import datetime as dt

from pyspark.sql import functions as F

from lipiflow.operators import tracking
from lipiflow.schemas import FILE_EVENT

T0 = dt.datetime(2024, 1, 1)



def test_gate(spark):
    ago = lambda m: T0 - dt.timedelta(minutes=m)
    rows = [
        ("same", "completed", 1, ago(9), "h", "h", False), ("changed", "completed", 1, ago(9), "h", "i", True), ("failed2", "failed", 2, ago(9), "h", "h", True), ("failed3", "failed", 3, ago(9), "h", "h", False),
        ("at59", "in_progress", 1, ago(59), "h", "h", False), ("at61", "in_progress", 1, ago(61), "h", "h", True), ("never", "in_progress", 1, None, "h", "h", False), ("pending", "pending", 0, None, "h", "h", True), ("skipped", "skipped", 0, None, "h", "h", True),
    ]
    ledger = spark.createDataFrame([r[:5] for r in rows], "file_id string, processing_status string, processing_attempts int, last_processed timestamp_ntz, file_hash string")
    listing = spark.createDataFrame([(r[0], r[5]) for r in rows] + [("new", "h")], "file_id string, new_hash string")
    got = {r.file_id: r.process for r in tracking.gate(listing, ledger, F.lit(T0).cast("timestamp_ntz")).collect()}
    assert got == {**{r[0]: r[6] for r in rows}, "new": True}


def test_fold_equals_sequence(spark):
    steps = [("a", 1, "seen"), ("a", 2, "started"), ("a", 3, "failed"), ("a", 4, "started"), ("a", 5, "completed"), ("b", 1, "started"), ("c", 1, "started"), ("c", 2, "failed"), ("d", 1, "started"), ("d", 2, "reset")]
    df = spark.createDataFrame([(f, s, T0 + dt.timedelta(hours=s), e, "bad" if e == "failed" else None, ["o"] if e == "completed" else None) for f, s, e in steps], FILE_EVENT)
    got = {r.file_id: (r.processing_status, r.processing_attempts, r.error_message, r.output_files) for r in tracking.fold_events(df).collect()}
    assert got == {"a": ("completed", 2, None, ["o"]), "b": ("in_progress", 1, None, []), "c": ("failed", 1, "bad", []), "d": ("pending", 1, None, [])}


def test_counts(spark):
    empty = spark.createDataFrame([], "file_id string, processing_status string, processing_attempts int, first_seen timestamp_ntz")
    s = tracking.statistics(empty).first()
    assert s.total_files == 0 and s.success_rate == 0
    assert {r.files for r in tracking.status_counts(empty).collect()} == {0}
