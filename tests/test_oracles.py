"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from openbell.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.columns and df.count() >= 0
    else:
        assert compare(df, duck, sql) is None


def test_entry_runs(spark):
    assert entry.entry(spark).columns == [
        "symbol", "date", "realized_range", "rv_lag_5", "rv_lag_22", "target"
    ]


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
