"""Queries with SQL text against DuckDB on the given tables, and the contract of the entry file."""

import glob
import os

import duckdb
import pandas as pd
import pytest
from check import difference, rows_of

import __spark_entry__ as entry
from panelweave.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    cursor = connection.execute(ORACLES[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
    assert difference(rows_of(QUERIES[name](spark, FOLDER)), want) == ""


def test_entry_has_one_query_for_each_operator_and_the_pipeline():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
