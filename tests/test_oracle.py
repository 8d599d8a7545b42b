"""Every registered query against its DuckDB statement on the smallest tables."""

import collections
import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, rows_of
from tierlake import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_sql_or_is_approximate():
    rows_only = set(catalog.QUERIES) - set(catalog.ORACLE_SQL)
    assert rows_only <= {"agg_monthly_customers_sketch", "lake_failure_trend", "lake_critical_failures"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert collections.Counter(a) == collections.Counter(b)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_net_revenue" in df.columns
