"""All registered queries of the engine's own operators, each with DuckDB SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow import lexicon as L
from lipiflow.functions import text as T
from lipiflow.operators import entities, extraction, rolls, tracking
from lipiflow.plans import duck as D
from lipiflow.plans.corpus import corpus, corpus_sql, rolls_sql
from lipiflow.plans.corpus import rolls as roll_pages
from lipiflow.plans.parts import parts as task_parts
from lipiflow.schemas import STATUSES
from lipiflow.sources import sinks

#: Parts of a group that meet in one place.
PAIR_BLOCK = 4_000
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}
NOW = "2024-06-01 12:00:00"
STAMP = "2024-06-01T12:00:00"


def moment(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CORPUS = f"c AS ({corpus_sql()})"
CLEANED = f"{CORPUS}, k AS (SELECT *, {D.clean('text')} AS c1 FROM c), k2 AS (SELECT *, {D.clean('c1')} AS c2 FROM k)"


def romanised(keys: str, source: str, col: str) -> str:
    """CTEs turning a column into its romanised form ``en``."""
    return f"(SELECT {keys}, {D.named('raw_en')} AS en FROM (SELECT *, {D.tidied('ro')} AS raw_en FROM (SELECT *, {D.romanise('cl')} AS ro FROM (SELECT *, {D.clean(col)} AS cl FROM {source}))))"


ENTITIES = f"""{CLEANED},
ctx AS (SELECT * FROM (SELECT doc_id, file_no, page_number, i, {D.strip('part')} AS name, s, e FROM ({D.matches('doc_id, file_no, page_number', 'k2', 'c2', L.CONTEXT, 1)})) WHERE {D.valid_name('name')}),
run AS (SELECT * FROM (SELECT doc_id, file_no, page_number, i, {D.strip('whole')} AS name, s, e FROM ({D.matches('doc_id, file_no, page_number', 'k2', 'c2', L.NAME)})) WHERE {D.valid_name('name')}),
named AS (
  SELECT 1 AS kind, *, {D.confidence('name', 0.7)} AS conf FROM ctx
  UNION ALL
  SELECT 2, *, {D.confidence('name', 0.5)} FROM (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id, name ORDER BY i) = 1) r
  WHERE NOT EXISTS (SELECT 1 FROM ctx WHERE ctx.doc_id = r.doc_id AND ctx.name = r.name)
), ents AS (
  SELECT doc_id, file_no, page_number, kind, i, name AS hi, en, lower(en) AS low, 'name' AS type, conf, s, e FROM {romanised('*', 'named', 'name')} WHERE en <> ''
  UNION ALL
  SELECT doc_id, file_no, page_number, 3, i, whole, 'Age: ' || part, lower('Age: ' || part), 'age', 0.9::DOUBLE, s, e FROM ({D.matches('doc_id, file_no, page_number', 'k', 'c1', L.AGE, 1)})
  UNION ALL
  SELECT doc_id, file_no, page_number, 4, i, whole, whole, lower(whole), 'date', 0.95::DOUBLE, s, e FROM ({D.matches('doc_id, file_no, page_number', 'k', 'c1', L.DATE)})
)"""
PER_PAGE = f"""{ENTITIES}, page AS (
  SELECT k.doc_id, k.file_no, k.page_number, k.text, k.c1, coalesce(n, 0) AS n, coalesce(names, 0) AS names, coalesce(total, 0) AS total
  FROM k LEFT JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE type = 'name') AS names, sum(conf) AS total FROM ents GROUP BY 1) USING (doc_id)
)"""


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.extract(corpus(spark, sf_dir))


def spans(df: DataFrame, found) -> DataFrame:
    return df.select("doc_id", F.posexplode(found).alias("i", "m")).select("doc_id", (F.col("i") + 1).cast("long").alias("i"), F.col("m.text").alias("match"), F.col("m.start").alias("s"), F.col("m.end").alias("e"))


# Text operators.


@query(f"WITH {CLEANED} SELECT doc_id, c1 AS once, c2 AS twice FROM k2")
def q01_clean_text(spark, sf_dir):
    once = corpus(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("once"))
    return once.withColumn("twice", T.clean_text(F.col("once")))


@query(f"WITH {CLEANED} SELECT doc_id, i, whole AS match, s, e FROM ({D.matches('doc_id', 'k', 'c1', L.NAME)})")
def q02_name_spans(spark, sf_dir):
    df = corpus(spark, sf_dir).withColumn("c1", T.clean_text(F.col("text")))
    return spans(df, T.matches(F.col("c1"), L.NAME))


@query(f"WITH {ENTITIES} SELECT doc_id, name, s, e FROM ctx")
def q03_context_names(spark, sf_dir):
    df = corpus(spark, sf_dir).withColumn("c1", T.clean_text(F.col("text"))).withColumn("c2", T.clean_text(F.col("c1")))
    found = F.arrays_zip(T.matches(F.col("c2"), L.CONTEXT).alias("m"), T.groups(F.col("c2"), L.CONTEXT, 1).alias("g"))
    out = df.select("doc_id", F.explode(found).alias("x")).select("doc_id", T.strip(F.col("x.g")).alias("name"), F.col("x.m.start").alias("s"), F.col("x.m.end").alias("e"))
    return out.filter(T.valid_name(F.col("name")))


@query(f"WITH {CLEANED} SELECT doc_id, i, whole AS match, s, e FROM ({D.matches('doc_id', 'k', 'c1', L.AGE, 1)})")
def q04_ages(spark, sf_dir):
    df = corpus(spark, sf_dir).withColumn("c1", T.clean_text(F.col("text")))
    return spans(df, T.matches(F.col("c1"), L.AGE))


@query(f"WITH {CLEANED} SELECT doc_id, i, whole AS match, s, e FROM ({D.matches('doc_id', 'k', 'c1', L.DATE)})")
def q05_dates(spark, sf_dir):
    df = corpus(spark, sf_dir).withColumn("c1", T.clean_text(F.col("text")))
    return spans(df, T.matches(F.col("c1"), L.DATE))


@query(f"WITH {CLEANED} SELECT doc_id, en AS english, lower(en) AS english_lower FROM {romanised('doc_id', 'c', 'text')}")
def q06_transliterate(spark, sf_dir):
    out = corpus(spark, sf_dir).select("doc_id", T.transliterate(F.col("text")).alias("english"))
    return out.withColumn("english_lower", F.lower("english"))


@query(f"""WITH {ENTITIES}
SELECT 'file' || file_no || '.pdf' AS original_filename, page_number, hi AS hindi_name, en AS english_name, low AS english_name_lowercase, type AS entity_type,
       round_even(conf, 3) AS confidence_score, s AS position_start, e AS position_end, '{STAMP}' AS extraction_timestamp,
       'comprehensive' AS processing_method, length(c1)::INT AS text_length
FROM ents JOIN k USING (doc_id, file_no, page_number)""")
def q07_entity_rows(spark, sf_dir):
    return entities.entity_rows(extracted(spark, sf_dir), F.concat(F.lit("file"), F.col("file_id"), F.lit(".pdf")), moment(NOW))


@query(f"WITH {ENTITIES} SELECT doc_id, name, {D.confidence('name', 0.7)} AS context_confidence, {D.confidence('name', 0.5)} AS pattern_confidence, {D.valid_name('name')} AS valid FROM (SELECT doc_id, c2 AS name FROM k2 WHERE c2 <> '')")
def q08_confidence(spark, sf_dir):
    df = corpus(spark, sf_dir).withColumn("c1", T.clean_text(F.col("text"))).select("doc_id", T.clean_text(F.col("c1")).alias("name")).filter("name <> ''")
    n = F.col("name")
    return df.select("doc_id", "name", T.name_confidence(n, "context").alias("context_confidence"), T.name_confidence(n, "pattern").alias("pattern_confidence"), T.valid_name(n).alias("valid"))


def letters(x: str) -> str:
    return f"list_distinct(string_split(replace({x}, ' ', ''), ''))"


def like(a: str, b: str) -> str:
    shared = f"len(list_intersect({letters(a)}, {letters(b)}))"
    return f"(CASE WHEN {a} = {b} THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE {shared} / (len({letters(a)}) + len({letters(b)}) - {shared}) END)::DOUBLE"


@query(f"SELECT a.p_partkey AS a, b.p_partkey AS b, {like('a.p_name', 'b.p_name')} AS similarity FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey")
def q09_similarity_pairs(spark, sf_dir):
    # A group of many parts is dealt into blocks, and every two blocks meet in a place of their own; letters are found once a part.
    n, key = task_parts(spark), ["p_brand", "p_size"]
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", *key)
    blocks = p.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / PAIR_BLOCK).cast("int").alias("blocks"))
    p = p.repartition(n, "p_partkey").withColumn("letters", T.letters(F.col("p_name"))).join(blocks, key).withColumn("own", F.pmod(F.xxhash64("p_partkey"), F.col("blocks")).cast("int"))
    p = p.select(*key, "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("meets"), "p_partkey", "p_name", "letters")
    place = [*key, "_i", "_j"]
    a = p.select(*key, F.col("own").alias("_i"), F.col("meets").alias("_j"), F.col("p_partkey").alias("a"), F.col("p_name").alias("name"), F.col("letters").alias("x")).repartition(n, *place)
    b = p.select(*key, F.col("meets").alias("_i"), F.col("own").alias("_j"), F.col("p_partkey").alias("b"), F.col("p_name").alias("other"), F.col("letters").alias("y")).repartition(n, *place)
    return a.join(b, place).filter("a < b").select("a", "b", T.similarity(F.col("name"), F.col("other"), F.col("x"), F.col("y")).alias("similarity"))


@query(f"""WITH RECURSIVE {ENTITIES}, o AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY kind, i) AS n, low, type, conf FROM ents
), step(doc_id, n, kept) AS (
  SELECT doc_id, 1::BIGINT, [{{'low': low, 'type': type, 'conf': conf}}] FROM o WHERE n = 1
  UNION ALL
  SELECT doc_id, n, CASE WHEN hit IS NULL THEN list_append(kept, x) WHEN x.conf > kept[hit].conf THEN list_append(list_concat(kept[1:hit - 1], kept[hit + 1:]), x) ELSE kept END
  FROM (SELECT s.doc_id, o.n, s.kept, {{'low': o.low, 'type': o.type, 'conf': o.conf}} AS x,
               (SELECT min(j) FROM (SELECT unnest(range(1, len(s.kept) + 1)) AS j) WHERE {like('s.kept[j].low', 'o.low')} >= 0.8) AS hit
        FROM step s JOIN o ON o.doc_id = s.doc_id AND o.n = s.n + 1)
)
SELECT doc_id, unnest(range(1, len(kept) + 1)) AS place, unnest(kept).low AS english, unnest(kept).type AS type, round_even(unnest(kept).conf, 3) AS confidence
FROM step QUALIFY n = max(n) OVER (PARTITION BY doc_id)""")
def q10_greedy_unique(spark, sf_dir):
    kept = entities.file_entities(extracted(spark, sf_dir), "doc_id")
    out = kept.select("doc_id", F.posexplode_outer("entities").alias("place", "e")).filter("e is not null")
    return out.select("doc_id", (F.col("place") + 1).cast("long").alias("place"), F.col("e.english_lowercase").alias("english"), F.col("e.entity_type").alias("type"), F.bround("e.confidence", 3).alias("confidence"))


# Pages and summaries.

DOCS_AS_PAGES = "(SELECT doc_id, source AS file_id, CAST(doc_id AS INT) AS page_number, CASE WHEN doc_id % 7 = 0 THEN '  ' ELSE text END AS text, CAST(40 + doc_id % 61 AS DOUBLE) / 100 AS confidence FROM documents)"


def docs_as_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("source").alias("file_id"), F.col("doc_id").cast("int").alias("page_number"), F.when(F.col("doc_id") % 7 == 0, "  ").otherwise(F.col("text")).alias("text"), ((F.lit(40) + F.col("doc_id") % 61).cast("double") / 100).alias("confidence"))


@query(f"""WITH m AS (
  SELECT file_id, count(*) AS total_pages, count(*) FILTER (WHERE {D.strip('text')} <> '') AS pages_with_text, sum(length(text))::BIGINT AS total_characters,
         round(avg(confidence), 9) AS avg_confidence, sum(len({D.words('text')}))::BIGINT AS total_words FROM {DOCS_AS_PAGES} GROUP BY 1
) SELECT *, total_characters / total_pages AS chars_per_page, pages_with_text / total_pages AS text_coverage,
  total_characters >= 10 * total_pages AND avg_confidence >= 0.6 AND pages_with_text / total_pages >= 0.5 AS valid FROM m""")
def q11_page_metrics(spark, sf_dir):
    pages = docs_as_pages(spark, sf_dir)
    out = extraction.page_metrics(pages, "file_id").drop("reason").withColumn("avg_confidence", F.round("avg_confidence", 9))
    words = pages.groupBy("file_id").agg(F.sum(T.word_count(F.col("text"))).alias("total_words"))
    return out.join(words, "file_id")


@query(f"""WITH {PER_PAGE}, v AS (SELECT *, CASE WHEN n > 0 THEN total / n ELSE 0 END AS mean, length(c1) AS size FROM page)
SELECT doc_id, n AS entity_count, names AS name_count, round(mean, 9) AS avg_confidence, size AS text_length, n >= 1 AND mean >= 0.5 AND size >= 10 AS is_valid,
  CASE WHEN n = 0 THEN 'No entities extracted' ELSE concat_ws('; ', CASE WHEN mean < 0.5 THEN 'Low confidence (' || printf('%.2f', mean) || ')' END, CASE WHEN size < 10 THEN 'Text too short (' || size || ')' END) END AS reason FROM v""")
def q12_entity_validation(spark, sf_dir):
    return entities.validate(extracted(spark, sf_dir), "doc_id").withColumn("avg_confidence", F.round("avg_confidence", 9))


@query(f"""WITH {PER_PAGE} SELECT count(*) AS total_pages, count(*) FILTER (WHERE n > 0) AS successful_pages, sum(n)::BIGINT AS total_entities, sum(names)::BIGINT AS total_names,
  round(sum(total) / sum(n), 9) AS avg_confidence, count(*) FILTER (WHERE n > 0) / count(*) AS success_rate FROM page""")
def q13_processing_summary(spark, sf_dir):
    return entities.processing_summary(extracted(spark, sf_dir)).withColumn("avg_confidence", F.round("avg_confidence", 9))


@query(f"""WITH {PER_PAGE}, w AS (
  SELECT 'Filename' AS "Metric", 'corpus.pdf' AS "Value"
  UNION ALL SELECT 'Total Pages', count(*)::VARCHAR FROM page UNION ALL SELECT 'Pages With Entities', count(*)::VARCHAR FROM page WHERE n > 0
  UNION ALL SELECT 'Total Entities', count(*)::VARCHAR FROM ents UNION ALL SELECT 'Average Confidence', round_even(avg(conf), 3)::VARCHAR FROM ents
  UNION ALL SELECT 'Min Confidence', round_even(min(conf), 3)::VARCHAR FROM ents UNION ALL SELECT 'Max Confidence', round_even(max(conf), 3)::VARCHAR FROM ents
  UNION ALL SELECT 'Earliest Processing', '{STAMP}' UNION ALL SELECT 'Latest Processing', '{STAMP}'
  UNION ALL SELECT upper(type[1:1]) || type[2:] || ' Count', count(*)::VARCHAR FROM ents GROUP BY type
) SELECT "Metric", "Value" FROM w""")
def q14_file_summary(spark, sf_dir):
    return entities.file_summary(extracted(spark, sf_dir), F.lit("corpus.pdf"), moment(NOW))


@query(f"""WITH p AS (SELECT * FROM {DOCS_AS_PAGES}), o AS (SELECT page_id AS doc_id, 'page ' || url AS text FROM pages)
SELECT coalesce(p.doc_id, o.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL OR (poor AND o.doc_id IS NOT NULL) THEN o.text ELSE p.text END AS text,
       CASE WHEN p.doc_id IS NULL OR (poor AND o.doc_id IS NOT NULL) THEN 'hybrid_ocr' ELSE 'direct_text' END AS extraction_method
FROM (SELECT *, confidence < 0.5 OR length({D.strip('text')}) < 10 AS poor FROM p) p FULL JOIN o ON o.doc_id = p.doc_id""")
def q15_hybrid_merge(spark, sf_dir):
    method = lambda m: F.lit(m).alias("extraction_method")
    own = docs_as_pages(spark, sf_dir).select(F.lit("f").alias("file_id"), "page_number", "doc_id", "text", "confidence", method("direct_text"))
    ocr = table(spark, sf_dir, "pages").select(F.lit("f").alias("file_id"), F.col("page_id").cast("int").alias("page_number"), F.col("page_id").alias("doc_id"), F.concat(F.lit("page "), "url").alias("text"), F.lit(0.9).alias("confidence"), method("ocr_tesseract"))
    return extraction.hybrid(own, ocr).select("doc_id", "text", "extraction_method")


@query(f"""WITH p AS (SELECT conv_id AS file_id, turn, coalesce(text, '') AS text, count(*) OVER (PARTITION BY conv_id) AS n, turn - min(turn) OVER (PARTITION BY conv_id) AS nth FROM conversations),
a AS (SELECT file_id, avg(length({D.strip('text')})) AS avg_length FROM p WHERE n <= 3 OR nth IN (0, n // 2, n - 1) GROUP BY 1)
SELECT file_id, round(avg_length, 9) AS avg_length, avg_length > 100 AS is_text_rich, CASE WHEN avg_length > 100 THEN 'direct' ELSE 'ocr' END AS method FROM a""")
def q16_text_richness(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("page_index"), "text")
    return extraction.text_richness(pages).withColumn("avg_length", F.round("avg_length", 9))


@query(f"""WITH w AS (SELECT conv_id, turn, unnest(range(1, len(ws) + 1)) AS i, ws FROM (SELECT conv_id, turn, string_split_regex(text, '\\s+') AS ws FROM conversations WHERE text IS NOT NULL)),
v AS (SELECT conv_id, turn, i, ws[i] AS word, (i * 7 + conv_id) % 101 - 1 AS conf FROM w WHERE ws[i] <> '')
SELECT conv_id, turn, string_agg(word, ' ' ORDER BY i) AS text, round(coalesce(avg(conf) FILTER (WHERE conf > 0), 0) / 100, 9) AS confidence FROM v GROUP BY ALL""")
def q17_ocr_fold(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    words = c.select("conv_id", "turn", F.posexplode(F.split("text", r"[\t\n\f\r ]+", -1)).alias("i", "text"))
    words = words.select("conv_id", "turn", (F.col("i") + 1).alias("word_index"), "text", ((F.col("i") + 1) * 7 + F.col("conv_id")).alias("k")).withColumn("conf", F.col("k") % 101 - 1)
    return extraction.fold_ocr_words(words, "conv_id", "turn").withColumn("confidence", F.round("confidence", 9))


# The ledger.

LEDGER = """(SELECT o_orderkey AS file_id, 'order' || o_orderkey || '.pdf' AS filename, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE md5(CAST(o_orderkey AS VARCHAR(20))) END AS file_hash, o_custkey AS file_size,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'completed' WHEN 'P' THEN 'in_progress' ELSE 'skipped' END AS processing_status,
  o_orderdate AS first_seen, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS last_processed, CAST(o_orderkey % 5 AS INT) AS processing_attempts FROM orders)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.element_at(F.create_map(*map(F.lit, ("F", "failed", "O", "completed", "P", "in_progress"))), F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        key.alias("file_id"),
        F.concat(F.lit("order"), key.cast("string"), F.lit(".pdf")).alias("filename"),
        F.when(key % 3 == 0, "").otherwise(F.md5(key.cast("string"))).alias("file_hash"),
        F.col("o_custkey").alias("file_size"),
        F.coalesce(status, F.lit("skipped")).alias("processing_status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("first_seen"),
        F.when(key % 11 != 0, F.col("o_orderdate").cast("timestamp_ntz")).alias("last_processed"),
        (key % 5).cast("int").alias("processing_attempts"),
    )


MIDDLE = "1996-07-01 00:30:00"
LISTING = "(SELECT o_orderkey + 3 AS file_id, md5(CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey ELSE o_orderkey + 3 END AS VARCHAR(20))) AS new_hash FROM orders)"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select((key + 3).alias("file_id"), F.md5(F.when(key % 4 == 0, key).otherwise(key + 3).cast("string")).alias("new_hash"))


GATE = f"""SELECT l.file_id, CASE WHEN processing_status IS NULL THEN true WHEN processing_status = 'completed' THEN coalesce(new_hash <> file_hash, false)
  WHEN processing_status = 'failed' AND processing_attempts >= 3 THEN false WHEN processing_status = 'in_progress' THEN coalesce(last_processed < TIMESTAMP '{MIDDLE}' - INTERVAL 1 HOUR, false) ELSE true END AS process
FROM {LISTING} l LEFT JOIN {LEDGER} t ON t.file_id = l.file_id"""


@query(GATE)
def q18_gate(spark, sf_dir):
    return tracking.gate(listing(spark, sf_dir), ledger(spark, sf_dir), moment(MIDDLE)).select("file_id", "process")


@query(f"""SELECT l.file_id, coalesce(processing_status = 'completed', false) AND (coalesce(file_hash = '', true) OR coalesce(file_hash = new_hash, false)) AS processed, coalesce(file_hash <> new_hash, true) AS changed
FROM {LISTING} l LEFT JOIN {LEDGER} t ON t.file_id = l.file_id""")
def q19_is_processed(spark, sf_dir):
    both = listing(spark, sf_dir).join(ledger(spark, sf_dir), "file_id", "left")
    return both.select("file_id", tracking.is_processed(F.col("processing_status"), F.col("file_hash"), F.col("new_hash")).alias("processed"), tracking.is_changed(F.col("new_hash"), F.col("file_hash")).alias("changed"))


@query(f"""WITH n AS (SELECT o_orderkey + 100 AS file_id, 'new' || o_orderkey AS filename, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'h' || o_orderkey END AS file_hash, o_orderkey % 4 AS file_size FROM orders)
SELECT coalesce(n.file_id, o.file_id) AS file_id, coalesce(n.filename, o.filename) AS filename, coalesce(nullif(n.file_hash, ''), o.file_hash, '') AS file_hash, coalesce(nullif(n.file_size, 0), o.file_size, 0) AS file_size,
  coalesce(processing_status, 'pending') AS processing_status, coalesce(first_seen, TIMESTAMP '{NOW}') AS first_seen, coalesce(processing_attempts, 0) AS processing_attempts,
  CASE WHEN o.file_id IS NULL THEN 'by=new' WHEN n.file_id IS NULL THEN 'by=old,kind=order' ELSE 'by=new,kind=order' END AS metadata
FROM n FULL JOIN {LEDGER} o ON o.file_id = n.file_id""")
def q20_upsert(spark, sf_dir):
    old = ledger(spark, sf_dir).withColumns({"error_message": F.lit(None).cast("string"), "output_files": F.array().cast("array<string>"), "metadata": F.create_map(F.lit("by"), F.lit("old"), F.lit("kind"), F.lit("order"))})
    key = F.col("o_orderkey")
    new = table(spark, sf_dir, "orders").select((key + 100).alias("file_id"), F.concat(F.lit("new"), key.cast("string")).alias("filename"), F.when(key % 2 == 0, "").otherwise(F.concat(F.lit("h"), key.cast("string"))).alias("file_hash"), (key % 4).alias("file_size"), F.create_map(F.lit("by"), F.lit("new")).alias("metadata"))
    pairs = F.sort_array(F.transform(F.map_entries("metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    out = tracking.upsert(old, new, F.to_timestamp_ntz(F.lit(NOW)))
    return out.select("file_id", "filename", "file_hash", "file_size", "processing_status", "first_seen", "processing_attempts", F.array_join(pairs, ",").alias("metadata"))


EVENTS = "(SELECT user_id AS file_id, event_id AS seq, ts, CASE event_type WHEN 'view' THEN 'started' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'seen' END AS event, event_type || event_id AS what FROM events)"
STATE = f"""state AS (SELECT file_id, CASE arg_max(event, seq) WHEN 'started' THEN 'in_progress' WHEN 'completed' THEN 'completed' WHEN 'failed' THEN 'failed' ELSE 'pending' END AS processing_status,
  min(ts) AS first_seen, max(ts) FILTER (WHERE event <> 'seen') AS last_processed, (count(*) FILTER (WHERE event = 'started'))::INT AS processing_attempts,
  CASE WHEN arg_max(event, seq) = 'failed' THEN arg_max(what, seq) END AS error_message, coalesce(string_agg(what, ',' ORDER BY seq) FILTER (WHERE event = 'completed'), '') AS outputs FROM {EVENTS} GROUP BY 1)"""
EVENT_NOW = "(SELECT max(ts) FROM events)"


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.create_map(*map(F.lit, ("view", "started", "purchase", "completed", "error", "failed", "click", "seen", "signup", "seen"))), F.col("event_type"))
    what = F.concat("event_type", F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("file_id"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp_ntz").alias("ts"), kind.alias("event"), what.alias("error_message"), F.array(what).alias("output_files"))


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.fold_events(file_events(spark, sf_dir))


def event_now(spark: SparkSession, sf_dir: str):
    return F.lit(file_events(spark, sf_dir).agg(F.max("ts")).first()[0]).cast("timestamp_ntz")


@query(f"WITH {STATE} SELECT * FROM state")
def q21_state_fold(spark, sf_dir):
    return state(spark, sf_dir).select("*", F.array_join("output_files", ",").alias("outputs")).drop("output_files")


@query(f"WITH {STATE} SELECT file_id, CASE WHEN processing_status = 'in_progress' AND last_processed < {EVENT_NOW} - INTERVAL 2 HOUR THEN 'pending' ELSE processing_status END AS processing_status FROM state")
def q22_stale_reset(spark, sf_dir):
    return tracking.reset_stale(state(spark, sf_dir), event_now(spark, sf_dir)).select("file_id", "processing_status")


@query(f"SELECT file_id, processing_status, first_seen FROM {LEDGER} WHERE NOT (processing_status IN ('completed', 'failed') AND first_seen < TIMESTAMP '{MIDDLE}' - INTERVAL 90 DAY)")
def q23_cleanup(spark, sf_dir):
    return tracking.without_old(ledger(spark, sf_dir), moment(MIDDLE)).select("file_id", "processing_status", "first_seen")


@query(f"""WITH {STATE} SELECT count(*) AS total_files, {', '.join(f"count(*) FILTER (WHERE processing_status = '{s}') AS {s}_files" for s in STATUSES)}, sum(processing_attempts)::BIGINT AS total_attempts,
  round_even(count(*) FILTER (WHERE processing_status = 'completed') / count(*) * 100, 2) AS success_rate, min(first_seen) AS oldest_record, max(first_seen) AS newest_record FROM state""")
def q24_tracker_statistics(spark, sf_dir):
    return tracking.statistics(state(spark, sf_dir))


@query(f"""WITH {STATE} SELECT s AS processing_status, (SELECT count(*) FROM state WHERE processing_status = s) AS files FROM (SELECT unnest([{', '.join(repr(s) for s in STATUSES)}]) AS s)""")
def q24_status_counts(spark, sf_dir):
    return tracking.status_counts(state(spark, sf_dir))


@query(f"WITH {STATE} SELECT file_id, processing_attempts, error_message FROM state WHERE processing_status = 'failed' AND processing_attempts < 3")
def q25_retryable(spark, sf_dir):
    return tracking.retryable(state(spark, sf_dir)).select("file_id", "processing_attempts", "error_message")


@query("SELECT md5(text) AS file_hash, array_to_string(list(doc_id ORDER BY doc_id), ',') AS file_ids, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def q26_duplicate_files(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), F.md5("text").alias("file_hash"))
    return tracking.duplicate_files(files).withColumn("file_ids", F.array_join(F.col("file_ids").cast("array<string>"), ","))


@query(f"SELECT o_orderkey AS file_id, o_orderdate AS modified_time FROM orders WHERE o_orderdate > TIMESTAMP '{MIDDLE}'")
def q27_incremental_scan(spark, sf_dir):
    from lipiflow.sources.files import changed_since

    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("modified_time"))
    return changed_since(rows, moment(MIDDLE))


@query(f"""WITH g AS ({GATE}), o AS (SELECT CASE WHEN NOT process THEN 'skipped' WHEN file_id % 10 = 0 THEN 'failed' ELSE 'processed' END AS outcome FROM g)
SELECT count(*) AS total_files, count(*) FILTER (WHERE outcome = 'processed') AS processed, count(*) FILTER (WHERE outcome = 'failed') AS failed, count(*) FILTER (WHERE outcome = 'skipped') AS skipped FROM o""")
def q28_cycle_counters(spark, sf_dir):
    outcome = F.when(~F.col("process"), "skipped").when(F.col("file_id") % 10 == 0, "failed").otherwise("processed")
    return tracking.cycle_counters(q18_gate(spark, sf_dir).withColumn("outcome", outcome))


@query(f"SELECT f.file_id, CASE WHEN l.file_id IS NULL THEN 'skipped' ELSE 'retry' END AS outcome FROM {LEDGER} f LEFT JOIN {LISTING} l ON l.file_id = f.file_id WHERE processing_status = 'failed' AND processing_attempts < 3")
def q28_retry_plan(spark, sf_dir):
    return tracking.retry_plan(tracking.retryable(ledger(spark, sf_dir)), listing(spark, sf_dir)).select("file_id", "outcome")


@query(f"SELECT file_id, ts, what AS error_message FROM {EVENTS} WHERE event = 'failed' ORDER BY ts DESC, file_id DESC LIMIT 10")
def q29_recent_errors(spark, sf_dir):
    return tracking.last_errors(file_events(spark, sf_dir).filter("event = 'failed'")).select("file_id", "ts", "error_message")


# Electoral rolls.


def fixed(x: str) -> str:
    x = D.replaced(f"coalesce({x}, '')", [(f"(cid:{k})", v) for k, v in L.CID.items()])
    return D.squeeze(D.replaced(rf"regexp_replace({x}, '\(cid:\d+\)', '', 'g')", L.REPAIRS))


def devanagari(x: str) -> str:
    return D.squeeze(rf"regexp_replace({x}, '[^ऀ-ॿ\s]', ' ', 'g')")


def real_name(x: str) -> str:
    return f"array_to_string(list_filter({D.words(devanagari(x))}, lambda v: NOT {D.within('v', L.NOT_NAMES)}), ' ')"


def roll_latin(x: str) -> str:
    x = D.romanise(devanagari(x))
    for a, b in L.ROLL_RULES:
        x = f"regexp_replace({x}, '{a.replace(chr(39), chr(39) * 2)}', '{b}', 'g')"
    for v in "aeiou":
        x = f"regexp_replace({x}, '{v}{v}+', '{v}', 'g')"
    w = D.words(D.squeeze(rf"regexp_replace({x}, '[^A-Za-z\-\s]', ' ', 'g')"))
    return f"array_to_string(list_transform({w}, lambda v: upper(v[1:1]) || lower(v[2:])), ' ')"


ROLLS = f"r AS ({rolls_sql()}), p AS (SELECT doc_id, file_no, {fixed('text')} AS page FROM r), p2 AS (SELECT *, {fixed('page')} AS line FROM p)"
STRICT, FALLBACK = L.roll_patterns()


def parts(pattern: str, fields: list[str], source: str) -> str:
    lists = ", ".join(f"regexp_extract_all(line, '{pattern}', {i}) AS {f}_s" for i, f in enumerate(fields, 1))
    return f"(SELECT doc_id, file_no, i, {', '.join(f'{f}_s[i] AS {f}' for f in fields)} FROM (SELECT *, unnest(range(1, len(sr_s) + 1)) AS i FROM (SELECT doc_id, file_no, {lists} FROM {source} WHERE length(page) >= 10)))"


MARKED = " OR ".join(f"contains(v, '{s}')" for s in L.SURNAMES)
VOTERS = f"""{ROLLS},
s0 AS (SELECT *, {real_name('name')} AS hi, {real_name('father')} AS fa FROM {parts(STRICT, ['sr', 'house', 'name', 'father', 'gender', 'age'], 'p2')}),
s AS (SELECT * FROM s0 WHERE age::INT BETWEEN 18 AND 120 AND length(hi) >= 2),
f0 AS (SELECT *, {D.words(fixed('middle'))} AS ws FROM {parts(FALLBACK, ['sr', 'middle', 'gender', 'age'], '(SELECT * FROM p2 WHERE doc_id NOT IN (SELECT doc_id FROM s))')}),
f1 AS (SELECT *, coalesce(list_position(list_transform(ws, lambda v: {MARKED}), true), 2) - 1 AS cut FROM f0),
f2 AS (SELECT *, CASE WHEN len(ws) < 2 THEN {fixed('middle')} ELSE array_to_string(ws[1:cut], ' ') END AS name, CASE WHEN len(ws) < 2 THEN '' ELSE array_to_string(ws[cut + 1:], ' ') END AS father FROM f1),
f AS (SELECT * FROM (SELECT *, {real_name('name')} AS hi, {real_name('father')} AS fa FROM f2) WHERE age::INT BETWEEN 18 AND 120 AND length(hi) >= 2),
v AS (
  SELECT doc_id, file_no, i, sr, coalesce(house, '') AS house, hi, fa, gender, age FROM s UNION ALL SELECT doc_id, file_no, i, sr, '', hi, fa, gender, age FROM f
), voters AS (
  SELECT doc_id, file_no, i - 1 AS seq, age::INT AS age, sr AS "srNo", house AS "houseNo", hi AS "voterNameHindi", {roll_latin('hi')} AS "voterName", lower({roll_latin('hi')}) AS "voterNameLower",
         fa AS "fatherOrHusbandNameHindi", {roll_latin('fa')} AS "fatherOrHusbandName", CASE WHEN gender IN ('पु', 'पुरुष') THEN 'M' ELSE 'F' END AS gender FROM v
)"""
VOTER_FIELDS = ["age", "srNo", "houseNo", "voterNameHindi", "voterName", "voterNameLower", "fatherOrHusbandNameHindi", "fatherOrHusbandName", "gender"]


@query(f"WITH {ROLLS} SELECT doc_id, page AS cleaned FROM p")
def q30_cid_cleaning(spark, sf_dir):
    return roll_pages(spark, sf_dir).select("doc_id", rolls.clean_cid(F.col("text")).alias("cleaned"))


HEADERS = ", ".join(f"coalesce(nullif(regexp_extract(page, '{p}', 1), ''), 'UNKNOWN-{f}') AS \"{f}\"" for f, p in L.HEADER.items())


@query(f"WITH {ROLLS} SELECT doc_id, {HEADERS} FROM p")
def q31_header_info(spark, sf_dir):
    df = roll_pages(spark, sf_dir).select("doc_id", rolls.clean_cid(F.col("text")).alias("page"))
    return df.select("doc_id", rolls.header(F.col("page")).alias("h")).select("doc_id", "h.*")


@query(f"WITH {VOTERS} SELECT doc_id, seq AS place, {', '.join(chr(34) + f + chr(34) for f in VOTER_FIELDS)} FROM voters")
def q32_voter_rows(spark, sf_dir):
    rows = rolls.voters(roll_pages(spark, sf_dir), "text", "doc_id")
    return rows.select("doc_id", F.col("_seq").cast("long").alias("place"), *VOTER_FIELDS)


@query(f"WITH {VOTERS} SELECT doc_id, sr, name, father, hi AS clean_name, fa AS clean_father FROM f")
def q33_voter_fallback(spark, sf_dir):
    pages = roll_pages(spark, sf_dir).select("doc_id", rolls.clean_cid(F.col("text")).alias("page")).withColumn("line", rolls.clean_cid(F.col("page")))
    middle = F.arrays_zip(T.groups(F.col("line"), FALLBACK, 1).alias("sr"), T.groups(F.col("line"), FALLBACK, 2).alias("middle"), T.groups(F.col("line"), FALLBACK, 4).alias("age"))
    valid_strict = rolls._valid(rolls._zipped(F.col("line"), STRICT, ["sr", "house", "name", "father", "gender", "age"]))
    # A page is a row, so its own strict voters say whether it falls back.
    loose = F.when((F.length("page") >= 10) & (F.size(valid_strict) == 0), middle)
    rows = pages.select("doc_id", F.explode_outer(loose).alias("x")).filter("x is not null").select("doc_id", F.col("x.sr").alias("sr"), F.col("x.age").cast("int").alias("age"), rolls.split_names(rolls.clean_cid(F.col("x.middle"))).alias("n"))
    out = rows.select("doc_id", "sr", "age", "n.name", "n.father", rolls.clean_name(F.col("n.name")).alias("clean_name"), rolls.clean_name(F.col("n.father")).alias("clean_father"))
    return out.filter("age between 18 and 120 and length(clean_name) >= 2").drop("age")


@query(f"WITH {VOTERS} SELECT file_no, \"srNo\", \"voterNameLower\", doc_id, age FROM voters QUALIFY row_number() OVER (PARTITION BY file_no, \"srNo\", \"voterNameLower\" ORDER BY doc_id, seq) = 1")
def q34_unique_voters(spark, sf_dir):
    rows = rolls.voters(roll_pages(spark, sf_dir), "text", "file_no", "doc_id")
    return rolls.unique_voters(rows, "file_no", "doc_id", "_seq").select("file_no", "srNo", "voterNameLower", "doc_id", "age")


@query(f"WITH {VOTERS} SELECT file_no, count(*) AS voters FROM (SELECT DISTINCT file_no, \"srNo\", \"voterNameLower\" FROM voters) GROUP BY ROLLUP (file_no)")
def q34_voter_totals(spark, sf_dir):
    return q34_unique_voters(spark, sf_dir).rollup("file_no").agg(F.count(F.lit(1)).alias("voters"))


@query(f"""WITH r AS ({rolls_sql()}), t AS (SELECT doc_id, coalesce(text, '') AS t FROM r), a AS (SELECT *, string_split(t, chr(10)) AS ls, list_filter(list_transform(regexp_extract_all(t, '\\b(\\d{{2}})\\b', 1), lambda x: x::INT), lambda x: x BETWEEN 18 AND 90) AS ages FROM t)
SELECT doc_id, len(regexp_extract_all(t, '[ऀ-ॿ]')) AS devanagari, len(ls) AS lines, len(list_filter(ls, lambda x: regexp_matches(x, '\\d+') AND length({D.strip('x')}) > 10)) AS numeric_lines,
  {', '.join(f"len(regexp_extract_all(t, '{g}')) AS gender_{i}" for i, g in enumerate(L.GENDERS))}, len(ages) AS age_candidates, array_to_string(ages[1:10], ',') AS ages, t[1:20] AS preview FROM a""")
def q35_diagnostics(spark, sf_dir):
    return rolls.diagnostics(roll_pages(spark, sf_dir), "text", "doc_id")


# Outputs.


@query(f"WITH {ENTITIES} SELECT count(*) AS row_count, count(*) FILTER (WHERE regexp_matches(hi, '[ऀ-ॿ]')) AS devanagari_rows, 12 AS column_count, '' AS errors, true AS valid FROM ents")
def q36_output_validation(spark, sf_dir):
    return sinks.validate_rows(entities.labelled(q07_entity_rows(spark, sf_dir)))


EXT = "lower(regexp_extract(url, '\\.([^./]*)$', 1))"


@query(f"""SELECT page_id, regexp_replace(url, '\\.[^.]*$', '') || '_processed_20240601_120000' AS output_name, CASE {EXT} WHEN 'csv' THEN 'text/csv' WHEN 'pdf' THEN 'application/pdf' WHEN 'txt' THEN 'text/plain' WHEN 'json' THEN 'application/json' ELSE 'application/octet-stream' END AS mime FROM pages""")
def q37_output_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.output_name(F.col("url"), "processed", moment(NOW)).alias("output_name"), T.mime_type(F.col("url")).alias("mime"))


@query(f"""WITH {ENTITIES}, j AS (
  SELECT doc_id, string_agg('{{"hindi_text":"' || hi || '","english_text":"' || en || '","english_lowercase":"' || low || '","entity_type":"' || type || '","confidence":' || conf || ',"page_number":' || page_number || ',"position":{{"start":' || s || ',"end":' || e || '}}}}', ',' ORDER BY kind, i) AS es FROM ents GROUP BY 1
) SELECT doc_id, '{{"filename":"corpus.pdf","processing_timestamp":"{STAMP}","pages":[{{"page_number":' || page_number || ',"processing_method":"' || CASE WHEN coalesce(text, '') = '' THEN 'empty' ELSE 'comprehensive' END || '",' || coalesce('"raw_text_length":' || length(text) || ',', '') || '"cleaned_text_length":' || length(c1) || ',"entities":[' || coalesce(es, '') || ']}}]}}' AS document
FROM k LEFT JOIN j USING (doc_id)""")
def q38_json_document(spark, sf_dir):
    return sinks.json_documents(extracted(spark, sf_dir), F.lit("corpus.pdf"), moment(NOW), "doc_id")


@query(f"""WITH {ENTITIES} SELECT page_number, hi AS hindi_name, '' AS english_name, type AS entity_type, doc_id AS extra_id, '' AS note FROM ents""")
def q39_column_ordering(spark, sf_dir):
    e = extracted(spark, sf_dir).select("doc_id", F.explode_outer("entities").alias("e")).filter("e is not null")
    rows = e.select(F.col("doc_id").alias("extra_id"), F.col("e.entity_type").alias("entity_type"), F.col("e.hindi_text").alias("hindi_name"), F.col("e.page_number").alias("page_number"))
    return entities.ordered_columns(entities.with_missing(rows, ("note", "english_name", *rows.columns)))


@query(f"WITH {CORPUS} SELECT doc_id, {roll_latin('t')} AS name FROM (SELECT doc_id, coalesce(text, '') AS t FROM c)")
def q40_roll_transliteration(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", rolls.transliterate_name(F.col("text")).alias("name"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
