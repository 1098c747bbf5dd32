"""Every registered query that has SQL gives the same rows as DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import check


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, con, sf_dir, name):
    assert check.compare(spark, con, name, sf_dir).startswith("ok")


def test_sql_belongs_to_registered_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 10
