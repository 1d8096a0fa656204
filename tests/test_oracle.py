"""Every catalog query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from lipiflow.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def tidy(v):
    return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v


def same(df, result):
    cols = sorted(df.columns)
    assert cols == sorted(result.columns)
    at = [result.columns.index(c) for c in cols]
    key = lambda r: [(v is None, str(v)) for v in r]
    got = sorted(([tidy(r[c]) for c in cols] for r in df.collect()), key=key)
    want = sorted(([tidy(r[i]) for i in at] for r in result.fetchall()), key=key)
    assert got == want


@pytest.mark.parametrize("name", catalog.queries())
def test_query(spark, duck, name):
    same(catalog.queries()[name](spark, SF), duck.sql(catalog.oracle_sql()[name]))
