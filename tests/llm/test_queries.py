"""The registered queries against their SQL, and the pipeline against its stages' rules."""

import re

import duckdb
import pytest

import corpus_pipeline
from lipiflow.llm import queries as q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", q.oracle_sql())
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.sql(q.oracle_sql()[name])
    df = q.queries()[name](spark, SF)
    cols = sorted(df.columns)
    assert cols == sorted(result.columns)
    at = [result.columns.index(c) for c in cols]
    tidy = lambda v: round(v, 6) if isinstance(v, float) else v
    key = lambda r: [(v is None, str(v)) for v in r]
    assert sorted(([tidy(r[c]) for c in cols] for r in df.collect()), key=key) == sorted(([tidy(r[i]) for i in at] for r in result.fetchall()), key=key)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [re.findall(r"\w+", r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    words = lambda t: re.findall(r"\w+", t.lower())
    leaky = {i for i, t in kept["simhash_dedup"].items() if any(" ".join(x) in " ".join(words(t)) for x in items)}
    assert leaky and not leaky & set(kept["decontamination"])
    sets = {i: {tuple(words(t)[j : j + 5]) for j in range(max(1, len(words(t)) - 4))} for i, t in kept["simhash_dedup"].items()}
    ids = sorted(sets)
    assert not [(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.85 * len(sets[a] | sets[b])]
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted({r.doc_id for r in out}) == sorted(kept["mixing"])


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF).count() == 0
