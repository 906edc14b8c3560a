"""Every registered query against its SQL in DuckDB, over whole tables."""

import os

import duckdb
import pytest

from starmill.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def rows_of(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [table[n].to_pylist() for n in names]
    return names, sorted(tuple(repr(v) for v in row) for row in zip(*columns))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    query, sql = QUERIES[name]
    found = query(spark, sf_dir).toArrow()
    expected = duck.sql(sql).to_arrow_table()
    assert rows_of(found) == rows_of(expected)


def test_every_query_has_sql():
    assert all(sql for _, sql in QUERIES.values())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
