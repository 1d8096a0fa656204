"""Files as a stream: the same page and entity operators over ``readStream``, exactly once per file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lipiflow.operators import entities
from lipiflow.sources.backends import EXTRACTORS, Extractor, extract_pages

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, folder: str, pattern: str = "*.pdf", max_files: int | None = None) -> DataFrame:
    """New files of a folder; the checkpoint knows which were seen, so late ones with old times are not lost."""
    reader = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(folder)
    return rows.select(F.md5(F.col("path").cast("binary")).alias("file_id"), F.element_at(F.split("path", "/"), -1).alias("filename"), F.md5("content").alias("file_hash"), "content")


def page_stream(files: DataFrame, extractors: tuple[Extractor, ...] = EXTRACTORS) -> DataFrame:
    return extract_pages(files, extractors)


def entity_stream(pages: DataFrame) -> DataFrame:
    """Entities are found page by page, without state."""
    return entities.extract(pages)


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """One pass over what is new, or a pass every ``seconds``; ``write`` gets each batch and its number."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)
    return writer.start()


def ledger_stream(events: DataFrame) -> DataFrame:
    """The running state of every file from a stream of events (output mode ``update`` or ``complete``)."""
    last = F.max_by(F.struct("ts", "event", "error_message"), "seq")
    out = events.groupBy("file_id").agg(last.alias("l"), F.min("ts").alias("first_seen"), F.count_if(F.col("event") == "started").cast("int").alias("processing_attempts"))
    from lipiflow.operators.tracking import STATUS_OF_EVENT

    status = F.element_at(F.create_map(*[F.lit(x) for kv in STATUS_OF_EVENT.items() for x in kv]), F.col("l.event"))
    return out.select("file_id", status.alias("processing_status"), "first_seen", "processing_attempts", F.when(F.col("l.event") == "failed", F.col("l.error_message")).alias("error_message"))
