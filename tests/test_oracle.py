"""Every registered query against its DuckDB twin on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from farelake.plans import oracle, queries
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()
NAMES = sorted(queries.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(records, order):
    def norm(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(queries.QUERIES)
    assert set(queries.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    s_order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    d_order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    assert _rows(df.collect(), s_order) == _rows(rel.fetchall(), d_order)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "airline" in df.columns
