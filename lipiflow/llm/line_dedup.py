"""Line dedup: winnowing over line hashes, positions joined, matches extended, later runs deleted.

A document is its sequence of non-blank lines.  Of every WINDOW neighbouring lines
the one with the smallest hash (of equal ones the last) is selected as fingerprint;
so is every long line by itself.  Two equal runs of WINDOW or more lines, or two
equal long lines, thus share a fingerprint at the same place.  A fingerprint is
kept once, with its position and the lines of all windows that selected it.

Fingerprints that occur once in the corpus are ruled out.  The others are joined,
each window of theirs with the first place that holds the same lines.  Matches
with the same document at the same distance extend one another to both sides into
runs, and the lines of every run that stands elsewhere before are deleted, while
its first occurrence stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.llm.common import documents, join_skewed, marked, marks, stage

#: Runs of this many lines and more are deleted where they occur again,
WINDOW = 2
#: and single lines of this many words and more.
LONG_WORDS = 50
NOT_BLANK = r"[^\x20\x09-\x0D]"


def _key(id_col: str, text_col: str) -> Column:
    """Rows of the same id and text are one document."""
    return F.xxhash64(F.col(id_col), F.col(id_col).isNull(), F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, long_words: int = LONG_WORDS) -> DataFrame:
    """One row per selected line: _id, _key, fingerprint, from (number of the context's first line in the sequence), windows, hashes, lines.

    ``hashes`` and ``lines`` (numbers in the text) are the context, all lines of the
    windows that selected the line; ``windows`` are (offset in the context, size).
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    rows = docs.select(F.col(id_col).alias("_id"), _key(id_col, text_col).alias("_key"), lines.alias("_lines"))
    long = F.octet_length  # cheap first: a line of n words has 2n - 1 bytes at least
    is_long = lambda x: (long(x) >= 2 * long_words - 1) & (F.regexp_count(x, F.lit(NOT_BLANK + "+")) >= long_words)
    made = F.transform("_lines", lambda x, i: F.struct(i.alias("at"), F.when(x.rlike(NOT_BLANK), F.xxhash64(x)).alias("h"), is_long(x).alias("long")))
    rows = rows.select("_id", "_key", F.filter(made, lambda x: x["h"].isNotNull()).alias("_seq"))
    rows = rows.select("_id", "_key", "_seq", F.transform("_seq", lambda x: x["h"]).alias("_h"), (F.size("_seq") - window).alias("_last"))

    # The windows (by first line, from 0) that select line i are neighbours: those that begin after the last line before it
    # with a smaller hash, and end before the first line after it with a hash as small.
    around = range(1, window)
    at = lambda i: F.get(F.col("_h"), i)

    def chosen(x: Column, i: Column) -> Column:
        first = F.greatest(i - (window - 1), F.lit(0), *[F.when(at(i - d) < x["h"], i - d + 1).otherwise(0) for d in around])
        last = F.least(i, F.col("_last"), *[F.when(at(i + d) <= x["h"], i + d - window).otherwise(i) for d in around])
        some = first <= last
        low = F.when(some, first).otherwise(i)
        count = F.when(some, last - first + 1).otherwise(0)
        own = F.when(x["long"] & (window > 1), F.array(F.struct((i - low).alias("at"), F.lit(1).alias("size")))).otherwise(F.array().cast("array<struct<at int, size int>>"))
        windows = F.when(some, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda k: F.struct(k.alias("at"), F.lit(window).alias("size")))).otherwise(F.array().cast("array<struct<at int, size int>>"))
        part = F.slice(F.col("_seq"), low + 1, F.when(some, count + window - 1).otherwise(1))
        return F.struct(x["h"].alias("fingerprint"), low.alias("from"), F.concat(windows, own).alias("windows"), F.transform(part, lambda y: y["h"]).alias("hashes"), F.transform(part, lambda y: y["at"]).alias("lines"))

    rows = rows.select("_id", "_key", F.explode(F.filter(F.transform("_seq", chosen), lambda f: F.size(f["windows"]) > 0)).alias("_f"))
    return rows.select("_id", "_key", "_f.*")


def repeated(rows: DataFrame) -> DataFrame:
    """The fingerprints that occur more than once, with few others."""
    prints = rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("fingerprint")
    prints = stage(prints, "line-prints")
    return marked(rows, "fingerprint", marks(prints, "fingerprint", "line-print-marks"), "_again").filter("_again").drop("_again")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, long_words: int = LONG_WORDS) -> DataFrame:
    """(_key, rows, runs): for documents that lose lines, how many rows they are and what they repeat.

    A run is (source, source_key, from, source_from, n): n lines of the sequence from
    number ``from``, which stand in the document ``source`` from ``source_from`` on.
    """
    rows = stage(repeated(stage(fingerprints(docs, id_col, text_col, window, long_words), "line-prints-all")), "line-candidates")
    each = rows.select("_id", "_key", "from", "hashes", "lines", F.explode("windows").alias("w"))
    part = lambda c: F.slice(F.col(c), F.col("w.at") + 1, F.col("w.size"))
    each = each.select("_id", "_key", (F.col("from") + F.col("w.at")).alias("at"), F.xxhash64(part("hashes")).alias("run"), part("lines").alias("lines"))
    place = F.struct(F.col("_id").alias("id"), F.col("_key").alias("key"), F.col("at").alias("at"))
    first = stage(each.groupBy("run").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first")).filter("_n > 1"), "line-first")
    total = rows.count()
    matched = join_skewed(each, first, "run", "_n", total, F.struct("_key", "at")).filter(F.col("_first") < place)
    # Copies of a row bring the same matches, which the set takes once before anything moves.
    match = F.struct(F.col("_first.id").alias("source"), F.col("_first.key").alias("source_key"), (F.col("_first.at") - F.col("at")).alias("away"), "at", "lines")
    found = matched.groupBy("_key").agg(F.collect_set(match).alias("_m"), F.count(F.lit(1)).alias("_n"))
    found = found.select("_key", (F.col("_n") / F.size("_m")).cast("long").alias("rows"), F.sort_array("_m").alias("_m"))
    end = lambda m: m["at"] + F.size(m["lines"])

    def joins(a: Column, b: Column) -> Column:
        """Whether match b goes on where match a, the one before it, is or ends."""
        return F.coalesce(a["source"].eqNullSafe(b["source"]) & (a["source_key"] == b["source_key"]) & (a["away"] == b["away"]) & (b["at"] <= end(a)), F.lit(False))

    heads = F.filter("_m", lambda m, i: ~joins(F.get(F.col("_m"), i - 1), m))
    tails = F.filter("_m", lambda m, i: ~joins(m, F.get(F.col("_m"), i + 1)))
    found = found.select("_key", "rows", "_m", F.arrays_zip(heads.alias("head"), tails.alias("tail")).alias("_r"))
    run = lambda r: F.struct(
        r["head"]["source"].alias("source"), r["head"]["source_key"].alias("source_key"), r["head"]["at"].alias("from"), (r["head"]["at"] + r["head"]["away"]).alias("source_from"), (end(r["tail"]) - r["head"]["at"]).alias("n")
    )
    return found.select("_key", "rows", F.transform("_r", run).alias("runs"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, long_words: int = LONG_WORDS) -> DataFrame:
    """``docs`` with repeated runs of lines deleted, and n_lines, removed (line numbers from 0).

    The order of places is (id, line); of equal ids, a hash of the text decides.
    A null text stays null and has one blank line; blank lines are kept and do not
    break a run; texts of fewer than ``window`` lines change only where they have a
    line of ``long_words`` words.  Rows with equal id and text are treated as one
    document and come out alike.  An empty table gives an empty result; columns of
    other names pass through, but one named n_lines or removed gives way.
    """
    runs = stage(repeated_runs(docs, id_col, text_col, window, long_words), "line-runs")
    # Only documents that lose lines move.
    whole = docs.drop("n_lines", "removed")
    rows = whole.select(F.struct(*[F.col(c) for c in whole.columns]).alias("_doc"), _key(f"{id_col}", f"{text_col}").alias("_key"))
    rows = marked(rows, "_key", marks(runs.select("_key"), "_key", "line-marks"), "_loses")
    losing = join_skewed(rows.filter("_loses").drop("_loses"), runs, "_key", "rows", max(1, docs.count()), F.monotonically_increasing_id(), "shuffle_hash").drop("rows")
    runs_type = dict(runs.dtypes)["runs"]
    keeping = rows.filter("not _loses").select("_doc", "_key", F.lit(None).cast(runs_type).alias("runs"))
    rows = losing.select("_doc", "_key", "runs").union(keeping)

    lines = F.split(F.coalesce(F.col(f"_doc.{text_col}"), F.lit("")), "\n", -1)
    filled = F.filter(F.transform("_l", lambda x, i: F.when(x.rlike(NOT_BLANK), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_l", lines).withColumn("_at", F.when(F.col("runs").isNotNull(), filled))
    # Numbers in the sequence of non-blank lines become numbers in the text.
    numbers = F.flatten(F.transform("runs", lambda r: F.slice(F.col("_at"), r["from"] + 1, r["n"])))
    rows = rows.withColumn("removed", F.coalesce(F.array_sort(F.array_distinct(numbers)), F.array().cast("array<int>")))
    kept = F.array_join(F.filter("_l", lambda x, i: ~F.array_contains("removed", i)), "\n")
    out = {c: F.col("_doc").getField(c) for c in whole.columns}
    out[text_col] = F.when(F.size("removed") == 0, out[text_col]).otherwise(kept)
    return rows.select(*[v.alias(k) for k, v in out.items()], F.size("_l").cast("long").alias("n_lines"), "removed")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(0, len(ls))) AS nr, ls FROM d),
s AS (SELECT doc_id, nr, ls[nr + 1] AS line FROM l WHERE regexp_matches(ls[nr + 1], '[^\x20\x09-\x0D]')),
w AS (
  SELECT doc_id, nr, lead(nr) OVER o AS nr2, line || chr(10) || lead(line) OVER o AS run
  FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY nr)
), f AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, nr) AS nth FROM w WHERE nr2 IS NOT NULL
), r AS (
  SELECT doc_id, nr FROM f WHERE nth > 1 UNION SELECT doc_id, nr2 FROM f WHERE nth > 1
  UNION SELECT doc_id, nr FROM (
    SELECT doc_id, nr, row_number() OVER (PARTITION BY line ORDER BY doc_id, nr) AS nth
    FROM s WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50
  ) WHERE nth > 1
), k AS (SELECT doc_id, list(nr ORDER BY nr) AS removed FROM r GROUP BY doc_id)
SELECT d.doc_id, len(d.ls) AS n_lines, coalesce(len(removed), 0) AS n_removed,
       coalesce(array_to_string(removed, ','), '') AS removed,
       sha256(array_to_string(list_transform(list_filter(range(0, len(ls)), lambda i: NOT coalesce(list_contains(removed, i), false)), lambda i: ls[i + 1]), chr(10))) AS text_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
