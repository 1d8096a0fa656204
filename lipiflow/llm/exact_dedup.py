"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Rows are grouped by the length of their text first.  The prefix is hashed only
where another row has the same length, and the whole text only where another row
has the same length and prefix.  Survivors of a step are marked in a bitmap that
is broadcast, so texts are read again but never shuffled; a clash in the bitmap
only lets a row through to the next step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.llm.common import documents, join_skewed, marked, marks, stage

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """White-space runs (ASCII) become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def refined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _text, _len, _prefix, _survives): the steps before the full hash.

    ``_prefix`` is null for a length that no other row has; ``_survives`` tells the
    rows that share length and prefix with another row.
    """
    rows = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text")).withColumn("_len", F.octet_length("_text"))
    lengths = stage(rows.groupBy("_len").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "exact-lengths")
    rows = marked(rows, "_len", marks(lengths.select("_len"), "_len", "exact-length-marks"), "_shared")
    rows = rows.withColumn("_prefix", F.when(F.col("_shared"), F.xxhash64(F.substring("_text", 1, PREFIX_CHARS)))).drop("_shared")
    keys = rows.filter("_prefix is not null").groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    keys = stage(keys.select(F.xxhash64("_len", "_prefix").alias("_key")), "exact-keys")
    rows = rows.withColumn("_key", F.xxhash64("_len", "_prefix"))
    rows = marked(rows, "_key", marks(keys, "_key", "exact-key-marks"), "_survives")
    return rows.withColumn("_survives", F.col("_survives") & F.col("_prefix").isNotNull()).drop("_key")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``text_sha256`` is null for rows that the length and the prefix already tell
    from all others, unless ``hash_all`` asks for every row's digest.

    Texts are equal when identical after white-space normalisation.  Nulls count
    as empty texts and equal each other; of equal rows the smallest id stays;
    a null id stays only where the whole group has none; repeated rows (same id and
    text) are one group and all marked kept, as they cannot be told apart.  An empty table gives an empty result.  Other columns
    of ``docs`` are ignored, whatever their names.
    """
    full = F.sha2("_text", 256)
    rows = refined(docs, id_col, text_col)
    rows = rows.select("_id", "_survives", (full if hash_all else F.when(F.col("_survives"), full)).alias("text_sha256"))
    rows = stage(rows, "exact-rows")
    groups = rows.filter("_survives").groupBy("text_sha256").agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = stage(groups.filter("group_size > 1"), "exact-groups")
    out = join_skewed(rows.select("_id", "text_sha256"), groups, "text_sha256", "group_size", rows.count(), F.col("_id"))
    return out.select(
        F.col("_id").alias(id_col),
        F.coalesce("keep_id", "_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("keep_id", "_id").eqNullSafe(F.col("_id")).alias("kept"),
        "text_sha256",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir), hash_all=True)


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), h AS (SELECT doc_id, sha256(norm) AS text_sha256 FROM t),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM h GROUP BY 1)
SELECT h.doc_id, g.keep_id, g.group_size, h.doc_id = g.keep_id AS kept, h.text_sha256
FROM h JOIN g USING (text_sha256)
"""
