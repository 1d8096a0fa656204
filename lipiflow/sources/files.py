"""Listings of files: full, by suffix, incremental, by id; contents and hashes come with the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str, suffix: str = ".pdf", content: bool = False, modified_after: str | None = None) -> DataFrame:
    """(file_id, filename, modified_time, file_size[, content, file_hash]) of a folder, suffix in either case.

    Contents are read only where asked for; a listing for the gate stays narrow.
    Files of no length are not seen.  ``modified_after`` prunes files before they are opened and is strict.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "false")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    rows = reader.load(folder).filter(F.lower("path").endswith(suffix.lower()))
    named = rows.select(F.md5(F.col("path").cast("binary")).alias("file_id"), F.element_at(F.split("path", "/"), -1).alias("filename"), "path", F.col("modificationTime").alias("modified_time"), F.col("length").alias("file_size"), *(["content"] if content else []))
    return named.withColumn("file_hash", F.md5("content")) if content else named


def first_of_each(listing: DataFrame, folder: Column) -> DataFrame:
    """The first file by path of every folder."""
    return listing.groupBy(folder.alias("folder")).agg(F.min_by(F.struct(*listing.columns), "path").alias("f")).select("folder", "f.*")


def changed_since(listing: DataFrame, last_check: Column | None) -> DataFrame:
    """Everything without a time; else what is strictly newer."""
    return listing if last_check is None else listing.filter(F.col("modified_time") > last_check)


def by_id(listing: DataFrame, file_id: str) -> DataFrame:
    return listing.filter(F.col("file_id") == file_id)


def fetched(ids: DataFrame, files: DataFrame) -> DataFrame:
    """(file_id, ok): whether each wanted file is there with its content."""
    return ids.join(files.select("file_id", "content"), "file_id", "left").select("file_id", F.col("content").isNotNull().alias("ok"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A ledger kept as one JSON object by file id; unreadable or absent is an empty ledger."""
    from lipiflow.schemas import FILE_RECORD

    record = FILE_RECORD.split(", ", 1)[1]
    try:
        text = spark.read.text(path, wholetext=True)
    except Exception as error:  # the path does not exist
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], FILE_RECORD)
    fields = ", ".join(f"{n}: {t}" for n, t in (x.split(" ") for x in record.split(", ")))
    return text.select(F.explode(F.from_json("value", f"map<string, struct<{fields}>>"))).select(F.col("key").alias("file_id"), "value.*")
