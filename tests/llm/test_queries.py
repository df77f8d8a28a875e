"""Registered corpus queries against their SQL, and their columns."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__
from tests.conftest import rows
from tillroll.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql()) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    relation = database.sql(ORACLE_SQL[name])
    assert sorted(relation.columns) == columns
    expected = relation.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    assert rows(df.select(*columns)) == sorted(expected, key=repr)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("op2_near_dup", "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean"),
        ("op3_decontamination", "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"),
        ("op4_mixing", "doc_id bigint, size bigint, source_size bigint, target double, taken bigint"),
        ("op5_nearest_neighbours", "query_id bigint, rank int, vec_id bigint, score double"),
        ("op7_secret_scan", "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"),
        ("op9_language_id", "doc_id bigint, held_out boolean, lang_pred string, score double"),
        ("op10_suffix_dedup", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"),
        ("op11_collocations", "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"),
        ("op12_simhash", "doc_id bigint, fingerprint string, component_id bigint"),
        ("op13_alignment", "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"),
    ],
)
def test_columns_of_the_contracts(spark, name, columns):
    types = dict(QUERIES[name](spark, FOLDER).dtypes)
    for column in columns.split(", "):
        assert types[column.split()[0]] == column.split()[1]
