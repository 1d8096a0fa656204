"""Electoral rolls: broken-font repair, page headers, voters, and their rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lipiflow import lexicon as L
from lipiflow.functions import text as T
from lipiflow.schemas import HEADER_FIELDS, VOTER_COLUMNS


def clean_cid(col: Column) -> Column:
    """Glyph numbers to letters, unknown ones away, known breaks repaired, white space squeezed."""
    out = reduce(lambda c, kv: F.replace(c, F.lit(f"(cid:{kv[0]})"), F.lit(kv[1])), L.CID.items(), F.coalesce(col, F.lit("")))
    out = F.regexp_replace(out, u"\\(cid:\\d+\\)", "")
    out = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), L.REPAIRS, out)
    return T.squeeze(out)


def devanagari_only(col: Column) -> Column:
    return T.squeeze(F.regexp_replace(F.coalesce(col, F.lit("")), T.u(r"[^ऀ-ॿ\s]"), " "))


def transliterate_name(col: Column) -> Column:
    """A voter's name in Latin letters, each word capitalised."""
    out = T.romanise(devanagari_only(col))
    for pattern, by in L.ROLL_RULES:
        out = F.regexp_replace(out, pattern, by)
    out = F.regexp_replace(out, r"([aeiou])\1+", "$1")
    return F.initcap(T.squeeze(F.regexp_replace(out, T.u(r"[^A-Za-z\-\s]"), " ")))


def header(col: Column) -> Column:
    """The eight header fields of a page; what is not found is UNKNOWN-<field>."""
    found = lambda f: F.coalesce(F.nullif(F.regexp_extract(col, T.u(L.HEADER[f]), 1), F.lit("")), F.lit(f"UNKNOWN-{f}"))
    return F.struct(*[found(f).alias(f) for f in HEADER_FIELDS])


def clean_name(col: Column) -> Column:
    return F.array_join(F.filter(T.words(devanagari_only(col)), lambda w: ~T.any_of(w, L.NOT_NAMES)), " ")


def split_names(middle: Column) -> Column:
    """struct(name, father): the relative's name begins at the first word with a surname in it, else at the second."""

    def halves(middle: Column, w: Column, at: Column) -> Column:
        part = lambda start, n: F.array_join(F.slice(w, start, n), " ")
        alone = F.size(w) < 2
        return F.struct(F.when(alone, middle).otherwise(part(F.lit(1), at)).alias("name"), F.when(alone, "").otherwise(part(at + 1, F.greatest(F.size(w) - at, F.lit(0)))).alias("father"))

    def second(w: Column) -> Column:
        marked = F.transform(w, lambda x: F.exists(F.array(*map(F.lit, L.SURNAMES)), lambda s: F.contains(x, s)))
        at = F.array_position(marked, True).cast("int") - 1
        return F.when(at < 0, 1).otherwise(at)

    return T.let(middle, lambda m: T.let(T.words(m), lambda w: T.let(second(w), lambda at: halves(m, w, at))))


def _zipped(line: Column, pattern: str, fields: list[str]) -> Column:
    return F.arrays_zip(*[T.groups(line, pattern, i + 1).alias(f) for i, f in enumerate(fields)])


def _valid(voters: Column) -> Column:
    age = lambda v: F.expr("1") * F.try_to_number(T.ascii_digits(v["age"]), F.lit("999"))
    return F.filter(voters, lambda v: age(v).between(18, 120) & (F.length(clean_name(v["name"])) >= 2))


def voters(pages: DataFrame, text_col: str = "text", *keys: str, extended: bool = False) -> DataFrame:
    """One row per voter of every page, with ``keys``, the header's fields, and ``_seq``, the voter's place on its page.

    A page's text is one line once cleaned.  Lines under 10 characters have no
    voters; where the strict pattern gives no valid voter the fallback is tried,
    and its middle part is split into the two names.
    """
    strict, fallback = L.roll_patterns(extended)
    line = F.col("_line")
    out = pages.select(*keys, clean_cid(F.col(text_col)).alias("_page")).withColumn("_line", clean_cid(F.col("_page")))
    out = out.withColumn("_header", header(F.col("_page")))
    part = lambda v, f: F.coalesce(v[f], F.lit(""))
    record = lambda v, house, name, father: F.struct(v["sr"].alias("sr"), house.alias("house"), name.alias("name"), father.alias("father"), v["gender"].alias("gender"), v["age"].alias("age"))
    first = F.transform(_zipped(line, strict, ["sr", "house", "name", "father", "gender", "age"]), lambda v: record(v, part(v, "house"), T.strip(v["name"]), T.strip(v["father"])))
    out = out.withColumn("_strict", _valid(F.when(F.length("_page") < 10, F.array().cast("array<struct<sr string, house string, name string, father string, gender string, age string>>")).otherwise(first)))
    loose = F.transform(_zipped(line, fallback, ["sr", "middle", "gender", "age"]), lambda v: T.let(split_names(clean_cid(v["middle"])), lambda names: record(v, F.lit(""), names["name"], names["father"])))
    chosen = F.when((F.size("_strict") > 0) | (F.length("_page") < 10), F.col("_strict")).otherwise(_valid(loose))
    # Outer, as the filter that the optimizer puts before a plain one would compute the voters twice.
    out = out.select(*keys, "_header", F.posexplode_outer(chosen).alias("_seq", "v")).filter("v is not null")
    out = out.withColumn("voterNameHindi", clean_name(F.col("v.name"))).withColumn("fatherOrHusbandNameHindi", clean_name(F.col("v.father")))
    out = out.withColumn("voterName", transliterate_name(F.col("voterNameHindi"))).withColumn("fatherOrHusbandName", transliterate_name(F.col("fatherOrHusbandNameHindi")))
    return out.select(
        *keys,
        "_seq",
        T.ascii_digits(F.col("v.age")).cast("int").alias("age"),
        *[F.col(f"_header.{f}").alias(f) for f in HEADER_FIELDS],
        "fatherOrHusbandName",
        "fatherOrHusbandNameHindi",
        F.lower("fatherOrHusbandName").alias("fatherOrHusbandNameLower"),
        F.when(F.col("v.gender").isin(*L.MALE), "M").otherwise("F").alias("gender"),
        F.col("v.house").alias("houseNo"),
        F.col("v.sr").alias("srNo"),
        "voterName",
        "voterNameHindi",
        F.lower("voterName").alias("voterNameLower"),
    )


def unique_voters(rows: DataFrame, file_col: str, *order: str) -> DataFrame:
    """The first row of every (srNo, voterNameLower) within a file."""
    w = Window.partitionBy(file_col, "srNo", "voterNameLower").orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def voter_rows(rows: DataFrame, source: Column) -> DataFrame:
    """The 20 output columns."""
    from lipiflow.operators.entities import with_missing

    return with_missing(rows.withColumn("sourceFile", source).withColumn("nagarNigam", F.lit("1")), VOTER_COLUMNS)


def diagnostics(pages: DataFrame, text_col: str = "text", *keys: str) -> DataFrame:
    """Per page: letters, lines, numeric lines, gender markers and likely ages; first 10 ages and 20-character preview."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(t, "\n", -1)
    ages = F.filter(F.transform(T.groups(t, r"\b(\d{2})\b", 1), lambda a: F.expr("0") + T.ascii_digits(a).cast("int")), lambda a: a.between(18, 90))
    return pages.select(
        *keys,
        F.regexp_count(t, F.lit("[ऀ-ॿ]")).cast("long").alias("devanagari"),
        F.size(lines).cast("long").alias("lines"),
        F.size(F.filter(lines, lambda x: x.rlike(T.u(r"\d+")) & (F.length(T.strip(x)) > 10))).cast("long").alias("numeric_lines"),
        *[F.regexp_count(t, F.lit(g)).cast("long").alias(f"gender_{i}") for i, g in enumerate(L.GENDERS)],
        F.size(ages).cast("long").alias("age_candidates"),
        F.array_join(F.slice(ages, 1, 10), ",").alias("ages"),
        F.substring(t, 1, 20).alias("preview"),
    )
