"""Every query with a SQL twin must give the same values in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.compare import rows_by_name

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    answer = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_by_name(frame.columns, frame.collect()) == rows_by_name(names, answer.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
