"""Column -> Column text functions, all inside the JVM.

White space and digits are Unicode's in every pattern ((?U)); trimming is by
pattern, as ``trim`` knows spaces only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lipiflow import lexicon as L


def u(pattern: str) -> str:
    return f"(?U){pattern}"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` names it, also inside other lambdas."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def any_of(col: Column, values: tuple[str, ...]) -> Column:
    return F.array_contains(F.array(*map(F.lit, values)), col)


def strip(col: Column) -> Column:
    return F.regexp_replace(col, u(r"^\s+|\s+$"), "")


def squeeze(col: Column) -> Column:
    return strip(F.regexp_replace(col, u(r"\s+"), " "))


def words(col: Column) -> Column:
    return F.filter(F.split(col, u(r"\s+"), -1), lambda w: w != "")


def word_count(col: Column) -> Column:
    return F.coalesce(F.size(words(col)), F.lit(0))


def clean_text(col: Column) -> Column:
    """Devanagari, digits, white space and ``.-/()`` stay; null becomes empty.  Not idempotent: a lone danda beside another stays once."""
    kept = F.regexp_replace(F.coalesce(col, F.lit("")), u(L.UNWANTED), " ")
    return F.regexp_replace(squeeze(kept), u(L.LONE_PUNCTUATION), " ")


def romanise(col: Column) -> Column:
    """Devanagari letters to Latin ones; the inherent vowel is written, final ones too."""
    plain = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), L.NUKTA.items(), col)
    voiced = F.regexp_replace(F.regexp_replace(plain, "([क-ह])", "$1a"), "a([ा-ौ्])", "$1")
    grouped = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), L.LETTER_GROUPS.items(), voiced)
    return F.translate(grouped, L.LETTERS_FROM, L.LETTERS_TO)


def looks_like_name(col: Column) -> Column:
    fits = lambda w: F.size(w).between(1, 4) & F.forall(w, lambda x: F.length(x).between(2, 20))
    return let(words(col), fits) & ~col.rlike(u(r"\d"))


def capitalise(col: Column) -> Column:
    """First letter of each word upper, the rest lower; words come out one space apart."""
    return F.initcap(F.array_join(words(col), " "))


def tidy_romanised(col: Column) -> Column:
    out = squeeze(col)
    for name in L.NAMES_WITHOUT_A:
        out = F.regexp_replace(out, rf"(?iU)\b({name})a\b", "$1")
    for double in L.TRAILING_DOUBLES:
        out = F.regexp_replace(out, rf"(?iU){double}\b", double[0])
    for mark in L.MARKS:
        out = F.replace(out, F.lit(mark), F.lit(""))
    return let(out, lambda x: F.when(looks_like_name(x), capitalise(x)).otherwise(x))


def transliterate(col: Column) -> Column:
    """Cleaned, romanised and tidied text; empty for null."""
    return tidy_romanised(romanise(clean_text(col)))


def valid_name(col: Column) -> Column:
    good = lambda w: (
        F.size(w).between(1, 4)
        & ~F.forall(w, lambda x: any_of(x, L.STOP_WORDS))
        & ~F.exists(w, lambda x: any_of(x, L.NOT_IN_NAMES))
        & ~F.forall(w, lambda x: F.length(x) == 1)
    )
    return (F.length(strip(col)) >= 2) & let(words(col), good)


def name_confidence(col: Column, method: str) -> Column:
    """Between 0.1 and 1; sums run in a fixed order, as they are of doubles."""
    sizes = F.transform(words(col), lambda x: F.length(x))
    return let(F.struct(F.size(sizes).alias("n"), F.aggregate(sizes, F.lit(0), lambda a, x: a + x).alias("total")), lambda w: _name_confidence(col, method, w["n"], w["total"] / w["n"]))


def _name_confidence(col: Column, method: str, n: Column, mean: Column) -> Column:
    value = F.lit(0.7 if method == "context" else 0.5)
    value = value + F.when(n.between(2, 3), 0.15).when(n == 1, 0.05).otherwise(0.0)
    value = value + F.when(F.exists(F.array(*map(F.lit, L.NAME_INDICATORS)), lambda i: F.contains(col, i)), 0.1).otherwise(0.0)
    value = value + F.when(mean.between(3, 8), 0.1).when(mean < 2, -0.2).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.1), value))


def matches(col: Column, pattern: str) -> Column:
    """array<struct<text, start, end>> of all matches, in code points, end exclusive."""
    found = F.regexp_extract_all(col, F.lit(u(pattern)), F.lit(0))
    gaps = F.split(col, u(pattern), -1)
    size = lambda parts, n: F.aggregate(F.slice(parts, F.lit(1), n), F.lit(0), lambda a, x: a + F.length(x))
    span = lambda x, start: F.struct(x.alias("text"), start.alias("start"), (start + F.length(x)).alias("end"))
    spans = lambda p: F.transform(p["found"], lambda x, i: let(size(p["gaps"], i + 1) + size(p["found"], i), lambda start: span(x, start)))
    return let(F.struct(found.alias("found"), gaps.alias("gaps")), spans)


def groups(col: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(col, F.lit(u(pattern)), F.lit(group))


def letters(col: Column) -> Column:
    """A text's characters without spaces as struct(low, high, rest, n): bits for ASCII's two halves, a list of all others, and how many."""
    plain = lambda c: F.ascii(c).between(1, 127)
    bits = lambda cs, half: F.aggregate(cs, F.lit(0).cast("long"), lambda a, c: F.when(plain(c) & (F.shiftright(F.ascii(c), 6) == half), a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64))).otherwise(a))
    made = lambda cs: F.struct(bits(cs, 0).alias("low"), bits(cs, 1).alias("high"), F.filter(cs, lambda c: ~plain(c)).alias("rest"), F.size(cs).alias("n"))
    return let(F.array_distinct(F.split(F.replace(col, F.lit(" "), F.lit("")), "")), made)


def similarity(a: Column, b: Column, x: Column | None = None, y: Column | None = None) -> Column:
    """Jaccard of the character sets without spaces; 1 if equal, 0 if one is empty.  ``x`` and ``y`` are the texts' ``letters``, if at hand."""
    if x is None or y is None:
        return let(F.struct(letters(a).alias("x"), letters(b).alias("y")), lambda p: similarity(a, b, p["x"], p["y"]))
    others = F.when((F.size(x["rest"]) == 0) | (F.size(y["rest"]) == 0), 0).otherwise(F.size(F.array_intersect(x["rest"], y["rest"])))
    shared = F.bit_count(x["low"].bitwiseAND(y["low"])) + F.bit_count(x["high"].bitwiseAND(y["high"])) + others
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(shared / (x["n"] + y["n"] - shared))


def mime_type(name: Column) -> Column:
    """By extension; what is not known is a stream of bytes."""
    ext = F.lower(F.regexp_extract(name, r"\.([^./]*)$", 1))
    return F.when(ext == "csv", "text/csv").when(ext == "pdf", "application/pdf").when(ext == "txt", "text/plain").when(ext == "json", "application/json").otherwise("application/octet-stream")


def title(col: Column) -> Column:
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def output_name(name: Column, suffix: str = "processed", at: Column | None = None) -> Column:
    """<stem>_<suffix>[_<time>]."""
    parts = [F.regexp_replace(name, r"\.[^.]*$", ""), F.lit(suffix)]
    return F.concat_ws("_", *parts, *([F.date_format(at, "yyyyMMdd_HHmmss")] if at is not None else []))


def ascii_digits(col: Column) -> Column:
    return F.translate(col, "०१२३४५६७८९", "0123456789")
