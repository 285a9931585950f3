"""Every query against its SQL on the smallest data, and the shape of some plans."""

import duckdb
import pytest
from conftest import plan

import __spark_entry__ as entry
from barloom.suite.oracles import ORACLES
from barloom.suite.queries import QUERIES
from barloom.suite.views import TABLES, VIEWS, duckdb_view, spark_view, spelled_out

SF = "/root/testdata/sf0.001"


def text(value):
    return value.isoformat() if hasattr(value, "isoformat") else repr(value)


def sorted_rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(text(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_view(spark, duck, name):
    df = spelled_out(spark_view(spark, SF, name))
    result = duck.execute(duckdb_view(name))
    columns = [d[0] for d in result.description]
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, result.fetchall())


def check_plan(shown):
    """No cross join, no Python, no window over all rows in one task."""
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in shown
    lines = shown.splitlines()
    for n, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert not any(" Window " in above for above in lines[max(0, n - 2) : n])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    check_plan(plan(df))
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 5334
