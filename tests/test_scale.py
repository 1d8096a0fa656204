"""Queries over pages: dealt to all tasks, dear expressions computed once, pairs in blocks."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lipiflow.functions import text as T
from lipiflow.operators import rolls
from lipiflow.plans import catalog, corpus
from tests.test_oracle import SF, same


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_of_one_small_file_are_dealt(spark):
    for made in (corpus.corpus(spark, SF), corpus.rolls(spark, SF)):
        assert made.rdd.getNumPartitions() >= 4 and made.count() == made.select("doc_id").distinct().count()


def test_names_are_split_once(spark):
    df = spark.createDataFrame([("अमर सिंह कमल",), ("अमर",), ("",), (None,)], "m string")
    names = df.select(rolls.split_names(rolls.clean_cid(F.col("m"))).alias("n"))
    assert plan(names).count("(cid:147)") == 1
    assert [tuple(r.n) for r in names.collect()] == [("अमर", "सिंह कमल"), ("अमर", ""), ("", ""), ("", "")]


@pytest.mark.parametrize("name", ("q14_file_summary", "q33_voter_fallback"))
def test_pages_are_read_once(spark, name):
    assert plan(catalog.queries()[name](spark, SF)).count("Relation") == 1


def test_similarity_of_all_kinds_of_letters(spark):
    texts = ["", " ", "  ", "abc", "cab a", "ABC", "az{~\x7f", "राम abc", "राम", "मोहन राम", "ab🙂", "🙂é", "0123@`"]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")

    def want(a, b):
        x, y = (set(t.replace(" ", "")) or {""} for t in (a, b))
        return 1.0 if a == b else 0.0 if not a or not b else len(x & y) / len(x | y)

    for r in df.withColumn("s", T.similarity(F.col("a"), F.col("b"))).collect():
        assert r.s == want(r.a, r.b), r


def test_pairs_of_a_group_in_blocks(spark, monkeypatch, tmp_path):
    con = duckdb.connect()
    con.sql(f"CREATE TABLE part AS SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#1' ELSE p_brand END AS p_brand, CAST(1 AS INT) AS p_size) FROM '{SF}/part.parquet'")
    con.sql("SELECT * FROM part").write_parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(catalog, "PAIR_BLOCK", 7)
    same(catalog.queries()["q09_similarity_pairs"](spark, str(tmp_path)), con.sql(catalog.oracle_sql()["q09_similarity_pairs"]))
