"""Names, ages and dates of pages: extraction, de-duplication, rows, checks and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lipiflow import lexicon as L
from lipiflow.functions import text as T
from lipiflow.schemas import ENTITY, ENTITY_COLUMNS, ENTITY_LABELS

def _entity(text: Column, english: Column, kind: str, confidence: Column, page: Column, m: Column) -> Column:
    return F.struct(
        text.alias("hindi_text"),
        english.alias("english_text"),
        F.lower(english).alias("english_lowercase"),
        F.lit(kind).alias("entity_type"),
        confidence.alias("confidence"),
        page.cast("int").alias("page_number"),
        F.struct(m["start"].alias("start"), m["end"].alias("end")).alias("position"),
    )


def _names(found: Column, method: str, page: Column) -> Column:
    made = F.transform(found, lambda m: T.let(T.transliterate(m["name"]), lambda english: _entity(m["name"], english, "name", T.name_confidence(m["name"], method), page, m)))
    return F.filter(made, lambda e: e["english_text"] != "")


def extract(pages: DataFrame, text_col: str = "text", page_col: str = "page_number") -> DataFrame:
    """``pages`` with cleaned_text, entities and processing_method.

    Names after an indicator come first, then runs of words that are not among
    them, then ages and dates.  Names are searched in text cleaned twice, ages and
    dates in text cleaned once, and spans refer to these.  Null and empty texts
    have no entities and method ``empty``.
    """
    page = F.col(page_col)
    out = pages.withColumn("cleaned_text", T.clean_text(F.col(text_col))).withColumn("_twice", T.clean_text(F.col("cleaned_text")))
    after = F.arrays_zip(T.matches(F.col("_twice"), L.CONTEXT).alias("m"), T.groups(F.col("_twice"), L.CONTEXT, 1).alias("g"))
    named = lambda name, m: F.struct(name.alias("name"), m["start"].alias("start"), m["end"].alias("end"))
    context = F.transform(after, lambda x: named(T.strip(x["g"]), x["m"]))
    out = out.withColumn("_context", F.filter(context, lambda x: T.valid_name(x["name"])))
    out = out.withColumn("_context", _names(F.col("_context"), "context", page))
    runs = F.filter(F.transform(T.matches(F.col("_twice"), L.NAME), lambda m: named(T.strip(m["text"]), m)), lambda x: T.valid_name(x["name"]))
    out = out.withColumn("_runs", runs)
    known = F.transform("_context", lambda e: e["hindi_text"])
    first = F.filter("_runs", lambda x, i: ~F.array_contains(known, x["name"]) & (F.array_position(F.transform("_runs", lambda y: y["name"]), x["name"]) == i + 1))
    clean = F.col("cleaned_text")
    ages = F.transform(F.arrays_zip(T.matches(clean, L.AGE).alias("m"), T.groups(clean, L.AGE, 1).alias("g")), lambda x: _entity(x["m"]["text"], F.concat(F.lit("Age: "), x["g"]), "age", F.lit(0.9), page, x["m"]))
    dates = F.transform(T.matches(clean, L.DATE), lambda m: _entity(m["text"], m["text"], "date", F.lit(0.95), page, m))
    found = F.concat("_context", _names(first, "pattern", page), ages, dates)
    empty = F.coalesce(F.col(text_col), F.lit("")) == ""
    out = out.withColumn("entities", F.when(empty, F.array().cast(f"array<{ENTITY}>")).otherwise(found))
    out = out.withColumn("processing_method", F.when(empty, "empty").otherwise("comprehensive"))
    return out.drop("_twice", "_context", "_runs")


def greedy_unique(entities: Column, threshold: float = 0.8, within_type: bool = False) -> Column:
    """Entities in order, each dropped if an accepted one is as similar; a surer one replaces that and goes last."""

    def like(u: Column, e: Column) -> Column:
        near = T.similarity(u["e"]["english_lowercase"], e["e"]["english_lowercase"], u["letters"], e["letters"]) >= threshold
        return near & (u["e"]["entity_type"] == e["e"]["entity_type"]) if within_type else near

    def step(kept: Column, e: Column) -> Column:
        def placed(at: Column) -> Column:
            better = e["e"]["confidence"] > F.get(kept, at - 1)["e"]["confidence"]
            without = F.filter(kept, lambda u, j: j != at - 1)
            return F.when(at == 0, F.concat(kept, F.array(e))).when(better, F.concat(without, F.array(e))).otherwise(kept)

        return T.let(F.array_position(F.transform(kept, lambda u: like(u, e)), True).cast("int"), placed)

    known = F.transform(entities, lambda e: F.struct(e.alias("e"), T.letters(e["english_lowercase"]).alias("letters")))
    kept = T.let(known, lambda all_: F.aggregate(all_, F.filter(all_, lambda e: F.lit(False)), step))
    return F.transform(kept, lambda x: x["e"])


def file_entities(extracted: DataFrame, file_col: str = "file_id", page_col: str = "page_number", threshold: float = 0.8, within_type: bool = False) -> DataFrame:
    """(file, entities): the entities of all pages in page order, similar ones once."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(page_col).alias("p"), F.col("entities").alias("e"))))
    grouped = extracted.groupBy(file_col).agg(F.flatten(F.transform(ordered, lambda x: x["e"])).alias("entities"))
    return grouped.withColumn("entities", greedy_unique(F.col("entities"), threshold, within_type))


def unique_across_pages(extracted: DataFrame, file_col: str = "file_id", page_col: str = "page_number", compact_to_first_page: bool = False, threshold: float = 0.8) -> DataFrame:
    """Pages with the entities left by ``file_entities``: each on its own page, or all on the first."""
    kept = file_entities(extracted, file_col, page_col, threshold)
    pages = extracted.drop("entities").join(kept.withColumnRenamed("entities", "_all"), file_col)
    if compact_to_first_page:
        first = pages.groupBy(file_col).agg(F.min(page_col).alias("_first"))
        pages = pages.join(first, file_col)
        own = F.when(F.col(page_col) == F.col("_first"), F.col("_all")).otherwise(F.array().cast(f"array<{ENTITY}>"))
        return pages.withColumn("entities", own).drop("_all", "_first")
    return pages.withColumn("entities", F.filter("_all", lambda e: e["page_number"] == F.col(page_col).cast("int"))).drop("_all")


def _each(col: str) -> Column:
    """As ``explode`` once nulls are filtered, but without a filter on the array's size, which the
    optimizer would push below everything that computes the array and so compute it twice."""
    return F.explode_outer(col)


def entity_rows(extracted: DataFrame, filename: Column, at: Column, include_metadata: bool = True, page_col: str = "page_number") -> DataFrame:
    """One row per entity with the output columns; pages without entities vanish."""
    rows = extracted.select(
        F.coalesce(F.nullif(filename, F.lit("")), F.lit("unknown")).alias("original_filename"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("extraction_timestamp"),
        "processing_method",
        F.length("cleaned_text").alias("text_length"),
        _each("entities").alias("e"),
    ).filter("e is not null")
    rows = rows.select(
        "original_filename",
        F.col("e.page_number").alias("page_number"),
        F.col("e.hindi_text").alias("hindi_name"),
        F.col("e.english_text").alias("english_name"),
        F.col("e.english_lowercase").alias("english_name_lowercase"),
        F.col("e.entity_type").alias("entity_type"),
        F.bround("e.confidence", 3).alias("confidence_score"),
        F.col("e.position.start").alias("position_start"),
        F.col("e.position.end").alias("position_end"),
        "extraction_timestamp",
        *(["processing_method", "text_length"] if include_metadata else []),
    )
    return ordered_columns(rows)


def ordered_columns(df: DataFrame, order: tuple[str, ...] = ENTITY_COLUMNS) -> DataFrame:
    """Known columns in their order, then all others by name."""
    return df.select(*[c for c in order if c in df.columns], *sorted(c for c in df.columns if c not in order))


def with_missing(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Exactly the columns of ``order``; absent ones are empty strings."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in order])


def labelled(df: DataFrame) -> DataFrame:
    """Columns under their labels; without one, words capitalised."""
    return df.withColumnsRenamed({c: ENTITY_LABELS.get(c, c.replace("_", " ").title()) for c in df.columns})


def _mean_confidence(entities: Column) -> Column:
    total = F.aggregate(F.transform(entities, lambda e: e["confidence"]), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(entities) > 0, total / F.size(entities)).otherwise(0.0)


def validate(extracted: DataFrame, *keys: str) -> DataFrame:
    """Per page: counts, mean confidence, whether it is valid, and why not."""
    n = F.size("entities")
    mean = _mean_confidence(F.col("entities"))
    length = F.length("cleaned_text")
    reasons = F.concat_ws(
        "; ",
        F.when(n < 1, F.concat(F.lit("Too few entities ("), n.cast("string"), F.lit(")"))),
        F.when(mean < 0.5, F.concat(F.lit("Low confidence ("), F.format_string("%.2f", F.bround(mean, 2)), F.lit(")"))),
        F.when(length < 10, F.concat(F.lit("Text too short ("), length.cast("string"), F.lit(")"))),
    )
    return extracted.select(
        *keys,
        n.cast("long").alias("entity_count"),
        F.size(F.filter("entities", lambda e: e["entity_type"] == "name")).cast("long").alias("name_count"),
        mean.alias("avg_confidence"),
        length.cast("long").alias("text_length"),
        ((n >= 1) & (mean >= 0.5) & (length >= 10)).alias("is_valid"),
        F.when(n == 0, "No entities extracted").otherwise(reasons).alias("reason"),
    )


def processing_summary(extracted: DataFrame) -> DataFrame:
    """One row over all pages; an empty input gives zeros."""
    n = F.size("entities")
    conf = F.aggregate(F.transform("entities", lambda e: e["confidence"]), F.lit(0.0), lambda a, x: a + x)
    good = (F.col("processing_method") != "failed") & (n > 0)
    pages, total = F.count(F.lit(1)), F.coalesce(F.sum(n), F.lit(0))
    return extracted.agg(
        pages.alias("total_pages"),
        F.count_if(good).alias("successful_pages"),
        total.cast("long").alias("total_entities"),
        F.coalesce(F.sum(F.size(F.filter("entities", lambda e: e["entity_type"] == "name"))), F.lit(0)).cast("long").alias("total_names"),
        F.when(total > 0, F.sum(conf) / total).otherwise(0.0).alias("avg_confidence"),
        F.when(pages > 0, F.count_if(good) / pages).otherwise(0.0).alias("success_rate"),
    )


def file_summary(extracted: DataFrame, filename: Column, at: Column) -> DataFrame:
    """(Metric, Value): totals, confidences and times of all pages, then a count per entity type."""
    # Entities are dear, so all metrics come from one pass: a row per type, then one row.
    ents = extracted.select(filename.alias("f"), at.alias("at"), F.posexplode_outer("entities").alias("nth", "e"))
    kinds = ents.groupBy(F.col("e.entity_type").alias("kind")).agg(
        F.min("f").alias("f"),
        F.min("at").alias("first"),
        F.max("at").alias("last"),
        F.count_if(F.coalesce("nth", F.lit(0)) == 0).alias("pages"),
        F.count_if(F.col("nth") == 0).alias("filled"),
        F.count("e").alias("n"),
        F.sum("e.confidence").alias("sum"),
        F.min("e.confidence").alias("min"),
        F.max("e.confidence").alias("max"),
    )
    moment = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sure = lambda c: F.coalesce(F.bround(c, 3), F.lit(0.0))
    metrics = {
        "filename": F.coalesce(F.nullif(F.min("f"), F.lit("")), F.lit("unknown")),
        "total_pages": total("pages"),
        "pages_with_entities": total("filled"),
        "total_entities": total("n"),
        "earliest_processing": moment(F.min("first")),
        "latest_processing": moment(F.max("last")),
        "average_confidence": sure(F.sum("sum") / F.nullif(F.sum("n"), F.lit(0))),
        "min_confidence": sure(F.min("min")),
        "max_confidence": sure(F.max("max")),
    }
    row = lambda name, value: F.struct(name.alias("Metric"), value.cast("string").alias("Value"))
    whole = kinds.agg(*[m.alias(name) for name, m in metrics.items()], F.collect_list(F.when(F.col("n") > 0, row(F.concat("kind", F.lit("_count")), F.col("n")))).alias("kinds"))
    rows = whole.select(F.explode(F.concat(F.array(*[row(F.lit(name), F.col(name)) for name in metrics]), F.col("kinds"))).alias("m"))
    return rows.select(T.title(F.col("m.Metric")).alias("Metric"), F.col("m.Value").alias("Value"))
