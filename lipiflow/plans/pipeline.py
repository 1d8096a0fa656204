"""The file pipeline: list, gate, extract, find entities, write, commit.

Every cycle appends events to the ledger's log and one row to the run log; nothing
is rewritten.  A file is claimed (started) before its content is read and ends
completed or failed.  A claim left behind by a crash is retaken after an hour by
the gate and reset after two by ``maintain``.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.config import Config
from lipiflow.operators import entities, extraction, tracking
from lipiflow.schemas import FILE_EVENT
from lipiflow.sources import backends, files, sinks

RUN = "run_id string, started_at timestamp_ntz, seconds double, processed bigint, failed bigint, skipped bigint"


class Pipeline:
    def __init__(self, spark: SparkSession, config: Config, extractors: tuple[backends.Extractor, ...] = backends.EXTRACTORS, recognise=None, suffix: str = ".pdf"):
        self.spark, self.config, self.extractors, self.recognise, self.suffix = spark, config, extractors, recognise, suffix
        self.running = True

    # State.
    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.config.ledger_path}/{name}"
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        there = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
        return self.spark.read.schema(schema).parquet(path) if there else self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        return self._read("events", FILE_EVENT + ", filename string, file_hash string")

    def ledger(self) -> DataFrame:
        """One record per file; name and hash are the latest seen."""
        e = self.events()
        names = e.groupBy("file_id").agg(F.max_by("filename", F.when(F.col("filename").isNotNull(), F.col("seq"))).alias("filename"), F.max_by("file_hash", F.when(F.col("file_hash").isNotNull(), F.col("seq"))).alias("file_hash"))
        return tracking.fold_events(e).join(names, "file_id")

    def _append(self, rows: DataFrame, event: str, now: dt.datetime, order: int) -> None:
        """``seq`` orders events by cycle and step; a step has one event per file."""
        seq = int(now.timestamp() * 1_000_000) * 10 + order
        has = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind).alias(c)
        out = rows.select("file_id", F.lit(seq).cast("long").alias("seq"), F.lit(now).cast("timestamp_ntz").alias("ts"), F.lit(event).alias("event"), has("error_message", "string"), has("output_files", "array<string>"), has("filename", "string"), has("file_hash", "string"))
        out.write.mode("append").parquet(f"{self.config.ledger_path}/events")

    # Cycles.
    def process(self, listing: DataFrame, now: dt.datetime, at: str) -> DataFrame:
        """Run the listed files (with content); returns (file_id, outcome, error_message)."""
        listing = listing.cache()
        self._append(listing, "started", now, 1)
        pages = backends.extract_pages(listing, self.extractors)
        if self.recognise:
            numbers = pages.filter(extraction.needs_ocr(F.col("confidence"), F.col("text"))).select("file_id", "page_number")
            pages = extraction.hybrid(pages, backends.ocr_pages(listing, numbers, self.recognise))
        pages = pages.join(listing.select("file_id", "filename"), "file_id")
        found = entities.unique_across_pages(entities.extract(pages)).cache()
        stamp = F.lit(now).cast("timestamp_ntz")
        rows = entities.entity_rows(found, F.col("filename"), stamp)
        target = f"{self.config.output_folder}/{at}"
        sinks.write_csv(rows, f"{target}/entities", delimiter=self.config.csv_delimiter, encoding=self.config.csv_encoding, single=False)
        sinks.write_csv(entities.file_summary(found, F.col("filename"), stamp), f"{target}/summary", delimiter=self.config.csv_delimiter, encoding=self.config.csv_encoding, labels=False)
        sinks.write_json(sinks.json_documents(found, F.col("filename"), stamp, "file_id"), f"{target}/documents")
        counts = found.groupBy("file_id").agg(F.sum(F.size("entities")).alias("n"))
        error = F.when(F.col("n").isNull(), "No text could be extracted").when(F.col("n") == 0, "No entities to write")
        done = listing.select("file_id").join(counts, "file_id", "left").select("file_id", F.when(error.isNull(), "processed").otherwise("failed").alias("outcome"), error.alias("error_message"), F.array(F.lit(f"{target}/entities")).alias("output_files")).cache()
        self._append(done.filter("outcome = 'processed'").select("file_id", "output_files"), "completed", now, 2)
        self._append(done.filter("outcome = 'failed'").select("file_id", "error_message"), "failed", now, 2)
        return done

    def run_cycle(self, now: dt.datetime | None = None, only: DataFrame | None = None) -> dict:
        """One cycle; ``only`` limits it to some file ids.  Returns its counters."""
        began, now = time.time(), now or dt.datetime.now(dt.UTC).replace(tzinfo=None)
        at = F.lit(now).cast("timestamp_ntz")
        seen = files.scan(self.spark, self.config.input_folder, self.suffix, content=True)
        if only is not None:
            seen = seen.join(only.select("file_id").distinct(), "file_id", "left_semi")
        if self.config.max_files is not None:
            seen = seen.orderBy("path").limit(self.config.max_files)
        known = self.ledger().select("file_id", "processing_status", "processing_attempts", "last_processed", "file_hash")
        # The decisions are written down: a cached plan over the event log would follow what is appended to it.
        name = f"{now:%Y%m%d_%H%M%S}-{uuid.uuid4().hex[:8]}"
        decided = f"{self.config.ledger_path}/decisions/{name}"
        gated = tracking.gate(seen.withColumnRenamed("file_hash", "new_hash"), known, at, self.config.max_retries)
        gated.select("file_id", F.col("new_hash").alias("file_hash"), "process").write.parquet(decided)
        gated = self.spark.read.parquet(decided)
        take = seen.drop("file_hash").join(gated.filter("process").select("file_id", "file_hash"), "file_id")
        take = take.select("file_id", "filename", "path", "content", "file_hash")
        done = self.process(take, now, name) if gated.filter("process").head(1) else None
        n = {r.outcome: r["count"] for r in done.groupBy("outcome").count().collect()} if done is not None else {}
        out = {"processed": n.get("processed", 0), "failed": n.get("failed", 0), "skipped": gated.filter("not process").count()}
        row = [(uuid.uuid4().hex, now, time.time() - began, out["processed"], out["failed"], out["skipped"])]
        self.spark.createDataFrame(row, RUN).write.mode("append").parquet(f"{self.config.ledger_path}/runs")
        return {"status": "completed", "total_files": sum(out.values()), **out, "cycle_time_seconds": row[0][2]}

    def run_continuous(self, seconds: int | None = None, maintain_every: int = 24 * 3600) -> None:
        """Cycles until ``stop``; upkeep once a day."""
        last = 0.0
        while self.running:
            self.run_cycle()
            if time.time() - last > maintain_every:
                self.maintain()
                last = time.time()
            time.sleep(seconds or self.config.polling_interval_seconds)

    def stop(self) -> None:
        self.running = False

    def process_file(self, file_id: str) -> dict:
        return self.run_cycle(only=self.spark.createDataFrame([(file_id,)], "file_id string"))

    def reprocess_failed(self, max_attempts: int | None = None) -> dict:
        failed = tracking.retryable(self.ledger(), max_attempts or self.config.max_retries)
        return {"total_failed": failed.count(), **self.run_cycle(only=failed)}

    def maintain(self, now: dt.datetime | None = None) -> int:
        """Put claims left for over two hours back; returns how many."""
        now = now or dt.datetime.now(dt.UTC).replace(tzinfo=None)
        left = self.ledger().filter(tracking.stale(F.lit(now).cast("timestamp_ntz"))).select("file_id").cache()
        n = left.count()
        if n:
            self._append(left, "reset", now, 0)
        return n

    # Reports.
    def status(self) -> dict:
        runs = tracking.pipeline_status(self._read("runs", RUN)).first().asDict()
        return {**runs, "files": tracking.statistics(self.ledger()).first().asDict()}

    def recent_errors(self, n: int = 10) -> list[dict]:
        errors = self.events().filter("event = 'failed'")
        return [r.asDict() for r in tracking.last_errors(errors, n).collect()]

    def report(self, path: str) -> None:
        """Status and records under ``path``."""
        import json

        self.spark.createDataFrame([(json.dumps(self.status(), default=str, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/status")
        sinks.export_records(self.ledger(), f"{path}/records")
