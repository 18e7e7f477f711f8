"""Every registered query against DuckDB over the given tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.01"
ROWS_ONLY = {"scan_bytes"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT or value != value:
        return "NULL"
    if isinstance(value, (bool, str)):
        return str(value)
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def rows_of(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(map(plain, row)) for row in frame[names].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS FROM '{SF_DIR}/events.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(contract.core_queries()) - set(contract.core_oracle_sql()) == ROWS_ONLY
    assert set(contract.core_oracle_sql()) <= set(contract.core_queries())


@pytest.mark.parametrize("name", sorted(contract.core_queries()))
def test_query(spark, duck, name):
    frame = contract.core_queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    found = frame.toPandas()
    assert len(found) > 0
    if name not in ROWS_ONLY:
        assert rows_of(found) == rows_of(duck.execute(contract.core_oracle_sql()[name]).df())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
