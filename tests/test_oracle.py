"""Every query against its SQL on the same tables."""

import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from bidweave.fixtures import catalog, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "events lineitem part".split()

#: Those of this library's own catalog; other folders bring their own tests.
QUERIES = {name: contract.queries()[name] for name in catalog.build()}
SQL = {name: contract.oracle_sql()[name] for name in catalog.sql()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def cell(value):
    return str(value.normalize()) if isinstance(value, decimal.Decimal) else value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(oracle.JOBS))
def test_window_of_each_job_cuts(duck, name):
    """Without its window, or with one that is an hour off, a job has other rows."""
    kept = oracle.JOBS[name][0]
    sums = "SELECT count(*), sum(event_id) FROM log"
    cut = duck.execute(f"{oracle.log_ctes(oracle.LINEITEM_INPUTS, kept)} {sums}").fetchone()
    for other in ("true", oracle.hours_from_midnight(-2, 24), oracle.hours_from_midnight(0, 23)):
        got = duck.execute(f"{oracle.log_ctes(oracle.LINEITEM_INPUTS, other)} {sums}").fetchone()
        assert 0 < cut[0] and cut != got


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    got, want = bag(df.columns, map(tuple, df.collect())), bag(columns, expected.fetchall())
    assert sum(want.values()) > 0
    assert got == want
