"""License scan by diagonal voting.

Every rolling word k-gram of a text is joined by hash with the positions at
which license templates hold it.  A match at text word p and template word t
votes for the diagonal p - t; votes are counted by diagonal, neighbouring
diagonals of a long template are merged (small insertions or deletions), and a
span counts only if enough of the template's k-grams stand on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lipiflow.llm.common import documents

K = 2
#: Diagonals of a long template this near to each other are one span.
GAP = 3
#: The part of a long template's k-grams that must be found.
MIN_COVER = 0.5

# Short phrases, found only word for word, and opening sentences of license texts.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
TEXTS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-text",
    "licensed under the apache license version 2 0 you may not use this file except in compliance with the license": "apache-text",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-text",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-text",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-text",
    "this is free and unencumbered software released into the public domain": "unlicense-text",
}
# A template k-gram of these words alone casts no vote.
COMMON_WORDS = ("a", "and", "any", "are", "be", "for", "in", "is", "it", "may", "not", "of", "or", "that", "the", "this", "to", "under", "with", "you")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of the text with A-Z lowered; null counts as empty.

    ``lower`` also changes letters beyond ASCII, but only the Kelvin sign would
    become an ASCII letter on its own; it is replaced beforehand by another
    letter, so no word turns into a template's word.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("å")))
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def templates() -> list[tuple[str, bool, list[tuple[int, str]], int]]:
    """(label, is a phrase, voting k-grams with their positions, words); a template has at most 64 words."""
    out = []
    for table, phrase in ((PHRASES, True), (TEXTS, False)):
        for text, label in table.items():
            w = text.split()
            grams = [(i, w[i : i + K]) for i in range(len(w) - K + 1)]
            out.append((label, phrase, [(i, " ".join(g)) for i, g in grams if phrase or not set(g) <= set(COMMON_WORDS)], len(w)))
    return out


def _of(tpl: Column, values: list) -> Column:
    """A property of template number ``tpl``."""
    return F.element_at(F.array(*map(F.lit, values)), tpl + 1)


def _grams(spark: SparkSession) -> DataFrame:
    """A few hundred rows, whatever the corpus; one more stands for the mark that ends each text."""
    rows = [(n, i, *gram.split()) for n, (_, _, grams, _) in enumerate(templates()) for i, gram in grams]
    rows = spark.createDataFrame(rows, "tpl int, t int, a string, b string").select("tpl", "t", F.xxhash64("a", "b").alias("_hash"))
    return rows.union(spark.range(1).select(F.lit(-1), F.lit(0), F.xxhash64(F.lit("end of text"))))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per verified span, and one of template -1 per text.

    Columns: _row (tells repeated rows apart), id, n_words, tpl (number in
    ``templates()``), start and end word (end exclusive), cover (part of the
    template's voting k-grams found).  Null and empty texts have no words.  Other
    columns of ``docs`` are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), words_of(F.col(text_col)).alias("_words"))
    rows = rows.withColumn("n_words", F.size("_words"))
    grams = F.transform(F.slice("_words", 1, F.greatest(F.col("n_words") - 1, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(F.col("_words"), i + 1)))
    grams = F.concat(grams, F.array(F.xxhash64(F.lit("end of text"))))
    rows = rows.select("_row", "_id", "n_words", F.posexplode(grams).alias("_p", "_hash"))
    votes = rows.join(F.broadcast(_grams(docs.sparkSession)), "_hash")
    votes = votes.filter("tpl >= 0 or _p = greatest(n_words - 1, 0)")

    # Votes by diagonal; which template positions voted is kept as bits.
    known = templates()
    votes = votes.select("_row", "_id", "n_words", "tpl", F.when(F.col("tpl") >= 0, F.col("_p") - F.col("t")).otherwise(0).alias("_diag"), F.expr("shiftleft(1L, t)").alias("_bit"))
    keys = ["_row", "_id", "n_words", "tpl"]
    diags = votes.repartition("_row").groupBy(*keys, "_diag").agg(F.bit_or("_bit").alias("_bits"))
    w = Window.partitionBy("_row", "tpl").orderBy("_diag")
    gap = _of(F.greatest("tpl", F.lit(0)), [0 if phrase else GAP for _, phrase, _, _ in known])
    diags = diags.withColumn("_apart", F.coalesce((F.col("_diag") - F.lag("_diag").over(w) > gap).cast("int"), F.lit(0)))
    spans = diags.withColumn("_span", F.sum("_apart").over(w)).groupBy(*keys, "_span").agg(F.min("_diag").alias("start"), F.max("_diag").alias("_last"), F.bit_count(F.bit_or("_bits")).alias("_found"))
    tpl = F.greatest("tpl", F.lit(0))
    cover = F.col("_found") / _of(tpl, [len(grams) for _, _, grams, _ in known])
    spans = spans.withColumn("cover", F.when(F.col("tpl") >= 0, cover).otherwise(0.0))
    spans = spans.filter((F.col("tpl") < 0) | (F.col("cover") >= _of(tpl, [1.0 if phrase else MIN_COVER for _, phrase, _, _ in known])))
    end = F.col("_last") + _of(tpl, [n for _, _, _, n in known])
    return spans.select("_row", F.col("_id").alias(id_col), "n_words", "tpl", F.greatest("start", F.lit(0)).cast("long").alias("start"), end.cast("long").alias("end"), "cover")


def license_summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts, first and last phrase, labels and score."""
    known = templates()
    base = F.col("tpl").isin([n for n, t in enumerate(known) if t[1]])
    spans = license_spans(docs, id_col, text_col).groupBy("_row", id_col, "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.bit_or(F.when(F.col("tpl") >= 0, F.expr("shiftleft(1L, tpl)")).otherwise(0)).alias("_tpls"),
        F.max("cover").alias("score"),
    )

    def names(only_phrases: bool) -> Column:
        found = sorted((t[0], n) for n, t in enumerate(known) if t[1] or not only_phrases)
        return F.concat_ws(",", *[F.when(F.col("_tpls").bitwiseAND(F.lit(1 << n)) != 0, F.lit(label)) for label, n in found])

    return spans.select(id_col, F.col("n_words").cast("long"), "n_base", "first_word", "last_word", names(True).alias("base_labels"), names(False).alias("labels"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_summary(documents(spark, sf_dir))


def _sql() -> str:
    values = ", ".join(f"('{label}', {i}, '{gram}', {phrase}, {len(grams)}, {words})" for label, phrase, grams, words in templates() for i, gram in grams)
    return rf"""
WITH tpl(label, t, gram, phrase, grams, words) AS (VALUES {values}),
d AS (
  SELECT doc_id, regexp_extract_all(lower(replace(coalesce(text, ''), chr(8490), chr(229))), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), g AS (
  SELECT doc_id, unnest(range(0, greatest(len(w) - 1, 0))) AS p, w FROM d
), v AS (
  SELECT g.doc_id, label, phrase, grams, words, p - t AS diag, t
  FROM g JOIN tpl ON gram = w[p + 1] || ' ' || w[p + 2]
), diags AS (
  SELECT doc_id, label, phrase, grams, words, diag,
         coalesce(diag - lag(diag) OVER (PARTITION BY doc_id, label ORDER BY diag) > CASE WHEN phrase THEN 0 ELSE {GAP} END, false)::INT AS apart,
         ts
  FROM (SELECT doc_id, label, phrase, grams, words, diag, list(DISTINCT t) AS ts FROM v GROUP BY ALL)
), runs AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, label ORDER BY diag) AS span FROM diags
), spans AS (
  SELECT doc_id, label, phrase, greatest(min(diag), 0) AS start, len(list_distinct(flatten(list(ts)))) / any_value(grams) AS cover
  FROM runs GROUP BY doc_id, label, phrase, span
), ok AS (SELECT * FROM spans WHERE cover >= CASE WHEN phrase THEN 1.0 ELSE {MIN_COVER} END)
SELECT d.doc_id, any_value(len(d.w)) AS n_words, count(*) FILTER (WHERE phrase) AS n_base,
       min(start) FILTER (WHERE phrase) AS first_word, max(start) FILTER (WHERE phrase) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       coalesce(max(cover), 0)::DOUBLE AS score
FROM d LEFT JOIN ok ON ok.doc_id = d.doc_id GROUP BY d.doc_id
"""


SQL = _sql()
