"""Every registered core query against its SQL, at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest

from factlake.plans import ingest_queries, queries, stream_queries

QUERIES, SQL = queries.QUERIES | ingest_queries.QUERIES | stream_queries.QUERIES, queries.SQL | ingest_queries.SQL | stream_queries.SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT or isinstance(value, float) and value != value:
        return "null"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value.tolist() if hasattr(value, "tolist") else value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in os.listdir(SF):
        con.execute(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(SQL[name]).df())
