"""The processing ledger: an append-only event log, its fold, the gate, and statistics.

No step rewrites the whole state.  Events (started, completed, failed, seen) are
appended; a record is the fold of its events.  The time of a run is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.schemas import STATUSES

MAX_ATTEMPTS = 3
STATUS_OF_EVENT = {"seen": "pending", "started": "in_progress", "completed": "completed", "failed": "failed", "skipped": "skipped", "reset": "pending"}


def before(now: Column, hours: int = 0, days: int = 0) -> Column:
    return now - F.make_dt_interval(F.lit(days), F.lit(hours))


def should_process(now: Column, status: str = "processing_status", attempts: str = "processing_attempts", last: str = "last_processed", known_hash: str = "file_hash", new_hash: str = "new_hash", max_attempts: int = MAX_ATTEMPTS) -> Column:
    """The gate over a listing left-joined to the ledger; a null status is a new file."""
    s = F.col(status)
    changed = F.coalesce(F.col(new_hash) != F.col(known_hash), F.lit(False))
    return (
        F.when(s.isNull(), True)
        .when(s == "completed", changed)
        .when((s == "failed") & (F.col(attempts) >= max_attempts), False)
        .when(s == "in_progress", F.coalesce(F.col(last) < before(now, hours=1), F.lit(False)))
        .otherwise(True)
    )


def gate(listing: DataFrame, ledger: DataFrame, now: Column, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``listing(file_id, …, new_hash)`` with the ledger's columns and ``process``."""
    return listing.join(ledger, "file_id", "left").withColumn("process", should_process(now, max_attempts=max_attempts))


def is_processed(status: Column, known_hash: Column, local_hash: Column) -> Column:
    """Completed, and no local file, no stored hash, or the same hash."""
    return F.coalesce(status == "completed", F.lit(False)) & (local_hash.isNull() | F.coalesce(known_hash == "", F.lit(True)) | F.coalesce(known_hash == local_hash, F.lit(False)))


def is_changed(remote: Column, local: Column) -> Column:
    """Hashes differ, or one is missing."""
    return F.coalesce(remote != local, F.lit(True))


def upsert(ledger: DataFrame, files: DataFrame, now: Column) -> DataFrame:
    """New files enter as pending; known ones take the new name, a non-empty hash and size, and merged metadata."""
    old = ledger.select("file_id", F.struct(*[c for c in ledger.columns if c != "file_id"]).alias("o"))
    new = files.select("file_id", F.struct("filename", "file_hash", "file_size", "metadata").alias("n"))
    both = old.join(new, "file_id", "full_outer")
    some = lambda c, empty: F.coalesce(F.nullif(F.col(f"n.{c}"), F.lit(empty)), F.col(f"o.{c}"), F.lit(empty))
    merged = F.map_from_entries(F.concat(F.filter(F.map_entries(F.coalesce("o.metadata", F.create_map().cast("map<string,string>"))), lambda e: ~F.map_contains_key(F.coalesce("n.metadata", F.create_map().cast("map<string,string>")), e["key"])), F.map_entries(F.coalesce("n.metadata", F.create_map().cast("map<string,string>")))))
    return both.select(
        "file_id",
        F.coalesce("n.filename", "o.filename").alias("filename"),
        some("file_hash", "").alias("file_hash"),
        some("file_size", 0).alias("file_size"),
        F.coalesce("o.processing_status", F.lit("pending")).alias("processing_status"),
        F.coalesce("o.first_seen", now).alias("first_seen"),
        F.col("o.last_processed").alias("last_processed"),
        F.coalesce("o.processing_attempts", F.lit(0)).alias("processing_attempts"),
        F.col("o.error_message").alias("error_message"),
        F.coalesce("o.output_files", F.array().cast("array<string>")).alias("output_files"),
        merged.alias("metadata"),
    )


def fold_events(events: DataFrame) -> DataFrame:
    """One record per file from ``events(file_id, seq, ts, event, error_message, output_files)``."""
    last = F.max_by(F.struct("ts", "event", "error_message"), "seq")
    worked = F.max(F.when(F.col("event") != "seen", F.col("ts")))
    outputs = F.flatten(F.transform(F.sort_array(F.collect_list(F.when(F.col("event") == "completed", F.struct("seq", "output_files")))), lambda x: F.coalesce(x["output_files"], F.array().cast("array<string>"))))
    out = events.groupBy("file_id").agg(last.alias("l"), F.min("ts").alias("first_seen"), worked.alias("last_processed"), F.count_if(F.col("event") == "started").cast("int").alias("processing_attempts"), outputs.alias("output_files"))
    status = F.element_at(F.create_map(*[F.lit(x) for kv in STATUS_OF_EVENT.items() for x in kv]), F.col("l.event"))
    error = F.when(F.col("l.event") == "failed", F.col("l.error_message"))
    return out.select("file_id", status.alias("processing_status"), "first_seen", "last_processed", "processing_attempts", error.alias("error_message"), "output_files")


def stale(now: Column, hours: int = 2) -> Column:
    return F.coalesce((F.col("processing_status") == "in_progress") & (F.col("last_processed") < before(now, hours=hours)), F.lit(False))


def reset_stale(ledger: DataFrame, now: Column, hours: int = 2) -> DataFrame:
    return ledger.withColumn("processing_status", F.when(stale(now, hours), "pending").otherwise(F.col("processing_status")))


def old(now: Column, days: int = 90) -> Column:
    return F.coalesce(F.col("processing_status").isin("completed", "failed") & (F.col("first_seen") < before(now, days=days)), F.lit(False))


def without_old(ledger: DataFrame, now: Column, days: int = 90) -> DataFrame:
    return ledger.filter(~old(now, days))


def retryable(ledger: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    return ledger.filter((F.col("processing_status") == "failed") & (F.col("processing_attempts") < max_attempts))


def statistics(ledger: DataFrame) -> DataFrame:
    """One row: totals, a count for every status, success in percent, first and last sight."""
    n, s = F.count(F.lit(1)), F.col("processing_status")
    done = F.count_if(s == "completed")
    return ledger.agg(
        n.alias("total_files"),
        *[F.count_if(s == x).alias(f"{x}_files") for x in STATUSES],
        F.coalesce(F.sum("processing_attempts"), F.lit(0)).cast("long").alias("total_attempts"),
        F.when(n > 0, F.bround(done / n * 100, 2)).otherwise(0.0).alias("success_rate"),
        F.min("first_seen").alias("oldest_record"),
        F.max("first_seen").alias("newest_record"),
    )


def status_counts(ledger: DataFrame) -> DataFrame:
    """A row per status, counts of absent ones 0."""
    spark: SparkSession = ledger.sparkSession
    dim = spark.createDataFrame([(s,) for s in STATUSES], "processing_status string")
    counts = ledger.groupBy("processing_status").agg(F.count(F.lit(1)).alias("files"))
    return dim.join(counts, "processing_status", "left").select("processing_status", F.coalesce("files", F.lit(0)).alias("files"))


def duplicate_files(files: DataFrame, hash_col: str = "file_hash", id_col: str = "file_id") -> DataFrame:
    """(hash, ids, n) of every non-empty hash that more than one file has."""
    some = files.filter(F.coalesce(F.col(hash_col), F.lit("")) != "")
    return some.groupBy(hash_col).agg(F.sort_array(F.collect_list(id_col)).alias("file_ids"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def cycle_counters(outcome: DataFrame, status_col: str = "outcome") -> DataFrame:
    s = F.col(status_col)
    return outcome.agg(F.count(F.lit(1)).alias("total_files"), *[F.count_if(s == x).alias(x) for x in ("processed", "failed", "skipped")])


def retry_plan(failed: DataFrame, listing: DataFrame) -> DataFrame:
    """Failed files with ``outcome``: ``skipped`` where the listing has them no more, else ``retry``."""
    there = listing.select("file_id", F.lit(True).alias("_there"))
    return failed.join(there, "file_id", "left").withColumn("outcome", F.when(F.col("_there"), "retry").otherwise("skipped")).drop("_there")


def last_errors(errors: DataFrame, n: int = 10) -> DataFrame:
    """The n latest; with equal times the larger id first."""
    return errors.orderBy(F.col("ts").desc(), F.col("file_id").desc()).limit(n)


def pipeline_status(runs: DataFrame) -> DataFrame:
    """One row over the run log: runs, files, mean seconds."""
    n = F.count(F.lit(1))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return runs.agg(
        n.alias("runs_count"), total("processed").cast("long").alias("files_processed"), total("failed").cast("long").alias("files_failed"),
        F.min("started_at").alias("started_at"), F.max("started_at").alias("last_run"), F.when(n > 0, F.sum("seconds") / n).otherwise(0.0).alias("avg_processing_time"),
    )
