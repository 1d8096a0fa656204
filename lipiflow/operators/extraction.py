"""Pages of text: quality metrics, choice of method, and the merge of embedded and recognised text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lipiflow.functions import text as T


def page_metrics(pages: DataFrame, *keys: str) -> DataFrame:
    """Per file (``keys``) or over all pages: size, confidence, coverage, and whether the text will do."""
    n, filled = F.count(F.lit(1)), F.count_if(T.strip(F.col("text")) != "")
    chars = F.coalesce(F.sum(F.length("text")), F.lit(0))
    grouped = pages.groupBy(*keys) if keys else pages.groupBy()
    out = grouped.agg(n.alias("total_pages"), filled.alias("pages_with_text"), chars.cast("long").alias("total_characters"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("avg_confidence"))
    some = F.col("total_pages") > 0
    out = out.withColumn("chars_per_page", F.when(some, F.col("total_characters") / F.col("total_pages")).otherwise(0.0))
    out = out.withColumn("text_coverage", F.when(some, F.col("pages_with_text") / F.col("total_pages")).otherwise(0.0))
    valid = some & (F.col("total_characters") >= 10 * F.col("total_pages")) & (F.col("avg_confidence") >= 0.6) & (F.col("text_coverage") >= 0.5)
    return out.withColumn("valid", valid).withColumn("reason", F.when(~some, "No pages extracted").otherwise(""))


def needs_ocr(confidence: Column, text: Column) -> Column:
    return (confidence < 0.5) | (F.length(T.strip(text)) < 10)


def hybrid(pages: DataFrame, ocr: DataFrame, file_col: str = "file_id", faithful: bool = False) -> DataFrame:
    """Pages with poor text replaced by recognised ones of the same number, method ``hybrid_ocr``.

    A poor page without a recognised one keeps its own text; with ``faithful`` it
    is dropped.  A page known to ``ocr`` only (a file without any embedded text)
    comes in; with ``faithful`` it does not.
    """
    keys = [file_col, "page_number"]
    poor = needs_ocr(F.col("confidence"), F.col("text"))
    fields = [c for c in pages.columns if c not in keys]
    seen = ocr.select(*keys, F.struct(*[(F.lit("hybrid_ocr") if c == "extraction_method" else F.col(c)).alias(c) for c in fields]).alias("_ocr"))
    own = pages.select(*keys, F.struct(*fields).alias("_own"), F.coalesce(poor, F.lit(True)).alias("_poor"))
    both = own.join(seen, keys, "left" if faithful else "full_outer")
    if faithful:
        both = both.filter(~F.col("_poor") | F.col("_ocr").isNotNull())
    chosen = F.when(F.coalesce("_poor", F.lit(True)) & F.col("_ocr").isNotNull(), F.col("_ocr")).otherwise(F.col("_own"))
    return both.withColumn("_page", chosen).select(*[F.col(c) if c in keys else F.col(f"_page.{c}").alias(c) for c in pages.columns])


def fold_ocr_words(words: DataFrame, *keys: str) -> DataFrame:
    """(keys, text, confidence) from words with a confidence: non-blank words in order, mean of the positive confidences / 100."""
    kept = words.filter(T.strip(F.col("text")) != "")
    texts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("word_index", "text"))), lambda w: w["text"]), " ")
    sure = F.avg(F.when(F.col("conf") > 0, F.col("conf")))
    return kept.groupBy(*keys).agg(texts.alias("text"), (F.coalesce(sure, F.lit(0.0)) / 100).alias("confidence"))


def text_richness(pages: DataFrame, file_col: str = "file_id", index_col: str = "page_index", text_col: str = "text") -> DataFrame:
    """Per file: mean stripped length of up to three pages (first, middle, last), whether that is rich, and the method to take."""
    n = pages.groupBy(file_col).agg(F.count(F.lit(1)).alias("_n"), F.min(index_col).alias("_first"))
    at = F.col(index_col) - F.col("_first")
    sample = pages.join(n, file_col).filter((F.col("_n") <= 3) | at.isin(0) | (at == F.floor(F.col("_n") / 2)) | (at == F.col("_n") - 1))
    out = sample.groupBy(file_col).agg(F.avg(F.length(T.strip(F.coalesce(F.col(text_col), F.lit(""))))).alias("avg_length"))
    rich = F.col("avg_length") > 100
    return out.withColumn("is_text_rich", rich).withColumn("method", F.when(rich, "direct").otherwise("ocr"))
