"""The registered queries with SQL against DuckDB over the given tables."""

import os
import re

import duckdb
import pytest
from test_contract import rows_of

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    names = set(contract.queries()) - set(contract.core_queries())
    assert "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names - {"pipeline"}) == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", ["op6_ngram_join", "op8_chat", "op12_vector_codes", "op13_lexical"])
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    found = contract.queries()[name](spark, SF_DIR).toPandas()
    assert rows_of(found) == rows_of(connection.execute(contract.oracle_sql()[name]).df())
