"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from obsflow.registry import all_oracles, all_queries
from parity import connect, spark_rows, sql_rows

SF_DIR = contract.SMOKE_DIR
# Neither all pairs of two inputs nor rows handed to Python.
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "RDDScan")
# The optional operators for training text have tests of their own.
QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    names, rows = spark_rows(frame)
    expected_names, expected = sql_rows(connection, ORACLES[name])
    assert names == expected_names
    assert rows == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_the_flagship(spark):
    frame = contract.entry(spark)
    assert frame.columns[:4] == ["country", "state", "city", "date"]
    dates = [row.date for row in frame.select("date").collect()]
    assert dates == sorted(dates, reverse=True)
