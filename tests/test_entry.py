"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    df = __spark_entry__.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    relation = database.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected = relation.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    assert rows(df.select(*columns)) == sorted(expected, key=repr)


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() == 5383
