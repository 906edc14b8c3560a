"""Queries over a few rows whose file does not have them in the order of their keys."""

from datetime import datetime
from pathlib import Path

import duckdb
import pytest

from starmill import session
from starmill.registry import QUERIES, scans, tables
from starmill.workspace import Files, shared_dir

# Order, line, part, quantity: out of order, one line number missing.
LINES = [(3, 1, 2, 7.0), (1, 2, 1, 50.0), (2, None, 1, 4.0), (1, 1, 2, 3.0), (2, 1, 3, 9.0), (3, 2, 1, 1.0)]
TABLES = {
    "region": ("r_regionkey long, r_name string", [(0, "EUROPE")]),
    "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, "FRANCE", 0)]),
    "customer": (
        "c_custkey long, c_name string, c_nationkey long, c_acctbal double",
        [(1, "Customer#1", 0, 10.0), (2, "Customer#2", 0, 20.0)],
    ),
    "part": (
        "p_partkey long, p_name string, p_type string, p_size int, p_brand string, p_retailprice double",
        [(n, f"part {n}", "tin", 4, "B", 9.5) for n in (1, 2, 3)],
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
        [(n, n % 2 + 1, datetime(1995, n, 1)) for n in (1, 2, 3)],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
        [(o, p, 1, n, q, 100.0 * q, 0.1, datetime(1995, 6, 1)) for o, n, p, q in LINES],
    ),
}


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("few")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file:{folder}/{name}.parquet")
    return str(folder)


def expected(folder: str, name: str) -> list[dict]:
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        return connection.sql(QUERIES[name][1]).to_arrow_table().to_pylist()


def same_rows(found: list[dict], wanted: list[dict]) -> bool:
    return sorted(repr(sorted(r.items())) for r in found) == sorted(repr(sorted(r.items())) for r in wanted)


def test_loaded_facts_are_numbered_by_key(spark, few):
    found = QUERIES["lod_8"][0](spark, f"file:{few}").toArrow().to_pylist()
    assert [r["quantity"] for r in sorted(found, key=lambda r: r["sale_id"])] == [3, 9, 4, 7, 1]
    assert same_rows(found, expected(few, "lod_8"))


def test_star_view_numbers_sales_by_key(spark, few):
    found = QUERIES["jon_1"][0](spark, f"file:{few}").toArrow().to_pylist()
    assert [r["quantity"] for r in sorted(found, key=lambda r: r["sale_id"])] == [3, 50, 9, 4, 7, 1]
    assert same_rows(found, expected(few, "jon_1"))


def test_kept_lines_name_their_products(spark, few):
    found = QUERIES["jon_4"][0](spark, f"file:{few}").toArrow().to_pylist()
    assert {(r["order_id"], r["product_id"]) for r in found} == {
        ("ORD000000002", "P000001"), ("ORD000000002", "P000003"), ("ORD000000003", "P000001"), ("ORD000000003", "P000002"),
    }
    assert same_rows(found, expected(few, "jon_4"))


def test_partitions_grow_with_the_tables(spark, few, monkeypatch):
    before = spark.conf.get(session.PARTITIONS)
    size = sum(f.stat().st_size for f in Path(few, "lineitem.parquet").iterdir() if f.suffix == ".parquet")
    monkeypatch.setattr(session, "INPUT_A_PARTITION", 100)
    try:
        tables.table(spark, f"file:{few}", "lineitem")
        assert int(spark.conf.get(session.PARTITIONS)) >= size / 100 > int(before)
        most = spark.conf.get(session.PARTITIONS)
        tables.table(spark, f"file:{few}", "region")
        assert spark.conf.get(session.PARTITIONS) == most
    finally:
        spark.conf.set(session.PARTITIONS, before)


def test_a_large_table_is_not_read_by_more_tasks(spark, sf_dir, monkeypatch):
    limits = []
    read = scans.read_csv
    monkeypatch.setattr(scans, "SPLIT_ROWS", 1_000)
    monkeypatch.setattr(
        scans, "read_csv", lambda s, files: limits.append(int(s.conf.get("spark.sql.files.maxPartitionBytes"))) or read(s, files)
    )
    assert scans.csv_split(spark, sf_dir).count() == 6_000
    assert limits == [6 * 65536]


def test_sales_by_key_carry_one_number_and_are_removed_once_loaded(spark, few, monkeypatch):
    rows = tables.sales(spark, f"file:{few}", True, numbered=True)
    assert dict(rows.dtypes)["_ord"] == "bigint"
    assert [r["quantity"] for r in sorted(rows.collect(), key=lambda r: r["_ord"])] == [3, 50, 9, 4, 7, 1]
    files = Files(spark)
    before = set(files.names(f"{shared_dir(spark)}/starmill"))
    monkeypatch.setattr(tables, "_written", {})
    tables.loaded_warehouse(spark, f"file:{few}", by_key=True)
    left = set(files.names(f"{shared_dir(spark)}/starmill")) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["warehouse"]
