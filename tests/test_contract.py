"""Every registered query against its SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.compare import sorted_rows

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(FOLDER):
        connection.execute(
            f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_equals_sql(spark, database, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    wanted = database.execute(contract.oracle_sql()[name]).df()
    assert sorted_rows(got) == sorted_rows(wanted)
    assert len(got) > 0


def test_every_sql_has_a_query():
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "occupation", "age_group", "genre", "avg_rating", "rating_count", "rank"]
