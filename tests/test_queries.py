"""Every registered query against its SQL on DuckDB, over whole tables of the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry
import check
from crawlweft.plans.queries import ORACLES, QUERIES

SMALL = entry.SMALL


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = check.normal(QUERIES[name](spark, SMALL).toPandas())
    want = check.normal(con.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)
    assert len(got) > 0
