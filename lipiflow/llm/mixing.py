"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a budget of words.  Budgets beyond a source's size are met by
complete epochs first; what is left selects a fraction: each document draws an
exponential key scaled by its quality weight, the keys are sorted within the
source, and documents are taken while the running total of words stays nearest
to the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.llm.common import BROADCAST_ROWS, documents, join_small, running_total, stage

#: Source weights in code-point order of the source names, repeating; null comes last.
WEIGHTS = (1.0, 2.0, 3.0)
#: No source supplies more than this many times its size.
EPOCHS = 3
SEED = 17
#: Weight of a document of quality 1, of quality 0, and without a label.
QUALITY = (2.0, 0.5, 1.0)


def text_size(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(id_col: str, seed: int) -> Column:
    """A number in (0, 1) from a hash of the id; 52 bits of MD5, so any engine can make it."""
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, epochs: int = EPOCHS) -> DataFrame:
    """(_source, source_size, target) from (_source, source_size).

    Targets share the given part of all words by weight; a source whose share is
    above ``epochs`` times its size stays there, and the rest is shared again.
    """
    spark = sizes.sparkSession
    sizes = sizes.withColumn("_none", F.col("_source").isNull()).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_total(sizes, [], ["_none", "_source"], "_one", "mix-rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("before"), F.lit(len(weights))) + 1).cast("int"))
    ranked = stage(ranked.select("_source", "source_size", weight.alias("_w")), "mix-sources")
    cap = F.col("source_size") * F.lit(float(epochs))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level = -1.0
    while True:  # the level only rises, and each round caps a source more or ends
        full = F.col("_w") * F.lit(level) > cap if level >= 0 else F.lit(False)
        row = ranked.agg(F.sum(F.when(full, cap).otherwise(0.0)).alias("capped"), F.sum(F.when(full, 0.0).otherwise(F.col("_w"))).alias("w")).first()
        new = (total - row.capped) / row.w if row.w else level
        if new <= level or not row.w:
            break
        level = new
    target = F.least(F.col("_w") * F.lit(max(level, 0.0)), cap)
    return ranked.select("_source", "source_size", target.alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality_col: str = "quality", weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: id, _source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the document, ``taken`` = copies * size.
    Null texts have size 0 and copies of the complete epochs; a null source is a
    source of its own, the last.  Rows with equal keys are ordered by size, equal
    rows are interchangeable.  Draws depend on id and seed only, so reruns agree.
    Without ``quality`` (id, 0/1) all documents weigh the same.  An empty table
    gives an empty result; other columns of either table are ignored.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), text_size(F.col(text_col)).alias("size"))
    w = F.lit(QUALITY[2])
    if quality is not None:
        quality = quality.select(F.col(id_col).alias("_id"), F.col(quality_col).alias("_q")).filter("_id is not null and _q is not null").groupBy("_id").agg(F.max("_q").alias("_q"))
        rows = rows.join(quality, "_id", "left")
        w = F.when(F.col("_q") == 1, QUALITY[0]).when(F.col("_q") == 0, QUALITY[1]).otherwise(QUALITY[2])
    rows = rows.select("_id", "_source", "size", (-F.log(_uniform("_id", seed)) / w).alias("_es"), F.col("_source").isNull().alias("_none"))
    rows = running_total(rows, ["_source"], ["_none", "_es", "_id", "size"], "size", "mix-keys")
    sizes = stage(rows.groupBy("_source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    goal = targets(sizes, weights, share, epochs).withColumnRenamed("_source", "_of")
    few = goal.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(goal) if few else goal, F.col("_source").eqNullSafe(F.col("_of")))
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(epochs))
    whole = F.when(F.col("source_size") > 0, whole).otherwise(0)
    rest = F.col("target") - whole * F.col("source_size")
    more = (whole < epochs) & (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= rest)
    copies = (whole + F.when(more, 1).otherwise(0)).cast("long")
    rows = rows.withColumn("copies", copies)
    return rows.select(F.col("_id").alias(id_col), "_source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), q AS (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1),
k AS (
  SELECT d.*, -ln((('0x' || substr(md5(doc_id || ':{SEED}'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
         / CASE q WHEN 1 THEN {QUALITY[0]} WHEN 0 THEN {QUALITY[1]} ELSE {QUALITY[2]} END AS es
  FROM d LEFT JOIN q USING (doc_id)
), r AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY es, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM k
), s AS (
  SELECT source, sum(size) AS source_size, 1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source
), level(n, v) AS (
  SELECT 0, (SELECT sum(source_size) / sum(w) FROM s)
  UNION ALL
  SELECT n + 1, (SELECT (sum(source_size) - sum(CASE WHEN w * v > 3 * source_size THEN 3 * source_size ELSE 0 END))
                        / sum(CASE WHEN w * v > 3 * source_size THEN 0 ELSE w END) FROM s)
  FROM level WHERE n < 25
), t AS (SELECT source, source_size, least(w * (SELECT max(v) FROM level), 3.0 * source_size)::DOUBLE AS target FROM s),
e AS (
  SELECT r.*, source_size, target, least(floor(target / source_size), 3) AS whole FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN whole < 3 AND size > 0 AND before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM e
"""
