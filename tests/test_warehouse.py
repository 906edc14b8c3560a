import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starmill import run
from starmill.operators import numbering
from starmill.operators.dimensions import customer_dimension, date_dimension, product_dimension
from starmill.operators.numbering import number_placed
from starmill.operators.sinks import FlatStore, export_csv, export_json
from starmill.plans import analytics, star_load
from starmill.plans.star_load import load_star, parts_of
from starmill.plans.warehouse import (
    DELETED, FACT, ConstraintError, ContractError, Warehouse, depth_of, holding, part_of,
)
from starmill.sources.generate import generate_sales
from starmill.workspace import FILE_CLEANUP, materialize, shuffles_dropped

SALE = (
    "place int, order_id string, order_date string, customer_id string, customer_name string, "
    "email string, country string, city string, product_id string, product_name string, "
    "category string, subcategory string, brand string, quantity long, unit_price double, "
    "discount double, total_amount double"
)


def sale(place, order, day, customer, product, **changes):
    row = {
        "place": place, "order_id": order, "order_date": day, "customer_id": customer,
        "customer_name": f"name {customer}", "email": f"{customer}@x", "country": "Spain",
        "city": "Madrid", "product_id": product, "product_name": f"thing {product}",
        "category": "Books", "subcategory": "Tech", "brand": "B", "quantity": 2,
        "unit_price": 10.0, "discount": 10.0, "total_amount": 18.0,
    }
    return tuple({**row, **changes}.values())


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), SALE).withColumn("_ord", F.struct("place")).drop("place")


def test_customer_dimension(spark):
    df = sales(
        spark,
        sale(1, "O1", "2024-03-01", "C1", "P1", country="UK", email="old"),
        sale(2, "O2", "2024-01-15", "C1", "P1", country="Peru", email="new"),
        sale(3, "O3", "2024-02-01", "C2", "P1"),
        sale(4, "O4", "2024-02-01", "C3", "P1", country="Mali"),
    )
    found = {r["customer_id"]: r for r in customer_dimension(df).collect()}
    first = found["C1"]
    assert (first["email"], first["region"], first["customer_segment"]) == ("old", "Europe", "B2B")
    assert first["first_purchase_date"] == date(2024, 1, 15)
    assert (found["C2"]["region"], found["C2"]["customer_segment"]) == ("Europe", "B2C")
    assert (found["C3"]["region"], found["C3"]["customer_segment"]) == ("Other", "B2C")


def test_product_dimension(spark):
    df = sales(
        spark,
        sale(1, "O1", "2024-03-01", "C1", "P1", unit_price=10.0),
        sale(2, "O2", "2024-03-01", "C1", "P1", unit_price=11.11),
    )
    row = product_dimension(df).first()
    assert row["cost_price"] == 6.33 and row["is_active"] == 1


def test_date_dimension(spark):
    days = {str(r["full_date"]): r for r in date_dimension(spark, "2024-02-28", "2024-07-01").collect()}
    leap = days["2024-02-29"]
    assert (leap["date_key"], leap["day_of_week"], leap["day_of_week_num"]) == (20240229, "Thursday", 4)
    assert (leap["month_name"], leap["quarter"], leap["is_weekend"]) == ("February", 1, 0)
    assert (leap["fiscal_year"], leap["fiscal_quarter"]) == (2023, 3)
    assert days["2024-03-02"]["is_weekend"] == 1
    assert (days["2024-07-01"]["fiscal_year"], days["2024-07-01"]["fiscal_quarter"]) == (2024, 1)
    assert days["2024-06-30"]["fiscal_quarter"] == 4


def test_load_and_reload(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    rows = materialize(
        generate_sales(spark, 300).withColumn("_ord", F.struct("order_id")), "t"
    )
    first = load_star(warehouse, rows)
    assert first.facts["rows_loaded"] == 300 and first.dates_inserted == 731
    keys = {r["customer_id"]: r["customer_key"] for r in warehouse.table("dim_customer").collect()}
    assert sorted(keys.values()) == list(range(1, len(keys) + 1))
    assert first.customers == {"new": len(keys), "updated": 0}

    again = load_star(warehouse, rows)
    assert again.customers == {"new": 0, "updated": len(keys)}
    assert again.dates_inserted == 0 and again.facts_replaced == 300
    facts = warehouse.table(FACT)
    assert facts.count() == 300
    ids = [r["sale_id"] for r in facts.orderBy("order_id").collect()]
    assert ids == list(range(301, 601))
    assert keys == {r["customer_id"]: r["customer_key"] for r in warehouse.table("dim_customer").collect()}
    assert first.orphans == {"customer_key": 0, "product_key": 0, "date_key": 0}
    assert all(r["holds"] for t in warehouse.schemas for r in warehouse.contract(t).collect())


def test_partial_reload_rewrites_nothing(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    load_star(warehouse, sales(
        spark,
        sale(1, "O1", "2022-05-01", "C1", "P1"), sale(2, "O2", "2023-05-01", "C1", "P1"),
        sale(3, "O2", "2023-05-01", "C2", "P1"), sale(4, "O3", "2023-06-01", "C2", "P1"),
        *[sale(9 + n, f"X{n}", "2021-06-01", "C2", "P1") for n in range(9)],
    ))
    old = warehouse.current().tables[FACT]
    load_star(warehouse, sales(spark, sale(1, "O2", "2024-01-01", "C9", "P2")))
    now = warehouse.current().tables[FACT]
    assert set(old) < set(now) and len(warehouse.current().tables[DELETED]) == 1
    found = warehouse.table(FACT).where("date_key > 20220000").orderBy("sale_id").collect()
    assert [(r["sale_id"], r["order_id"], r["date_key"]) for r in found] == [
        (1, "O1", 20220501), (4, "O3", 20230601), (14, "O2", 20240101),
    ]
    assert warehouse.table("dim_customer").count() == 3


def test_many_small_loads_are_merged(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    for n in range(7):
        load_star(warehouse, sales(spark, sale(1, f"O{n}", "2022-05-01", "C1", "P1")), most_loads=1)
    assert len(warehouse.current().tables[FACT]) == 1
    found = warehouse.table(FACT).orderBy("sale_id").collect()
    assert [(r["sale_id"], r["order_id"]) for r in found] == [(n + 1, f"O{n}") for n in range(7)]


def test_a_reloaded_order_opens_few_files_and_rewrites_none(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w", part_rows=40)
    rows = [sale(n, f"O{n % 150}", "2021-05-01", f"C{n % 90}", "P1") for n in range(600)]
    load_star(warehouse, sales(spark, *rows))
    before = warehouse.current()
    assert len(before.tables[FACT]) == 16 and len(before.tables["dim_customer"]) == 4
    batch = sales(spark, sale(1, "O7", "2021-05-01", "C1", "P1", quantity=9))
    assert len(holding(before.tables[FACT], parts_of(batch, "order_id", before.tables[FACT]))) == 1
    again = load_star(warehouse, batch)
    assert again.facts_replaced == 4 and again.customers == {"new": 0, "updated": 1}
    after = warehouse.current()
    assert set(before.tables[FACT]) < set(after.tables[FACT]) and len(after.tables[FACT]) == 17
    assert len(set(before.tables["dim_customer"]) - set(after.tables["dim_customer"])) == 1
    found = warehouse.table(FACT)
    assert found.count() == 597 and [r["quantity"] for r in found.where("order_id = 'O7'").collect()] == [9]
    assert warehouse.table(FACT, before).count() == 600  # older snapshots stay readable
    removed = warehouse.clean_up(keep=1)
    assert any(name.startswith("dim_customer/") for name in removed) or after.version
    assert warehouse.table(FACT).count() == 597 and warehouse.table("dim_customer").count() == 90


def test_dead_lines_go_once_they_are_many(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    load_star(warehouse, sales(spark, *[sale(n, f"O{n}", f"202{n % 2}-05-01", "C1", "P1") for n in range(8)]))
    kept = [f for f in warehouse.current().tables[FACT] if "sale_year=2021" in f]
    for turn, dead in ((1, 1), (2, 2), (3, 0)):
        load_star(warehouse, sales(spark, sale(1, "O0", "2020-05-01", "C1", "P1", quantity=turn)))
        assert warehouse.current().dead == dead and warehouse.table(FACT).count() == 8
        assert warehouse.table(FACT).where("order_id = 'O0'").first()["quantity"] == turn
    assert warehouse.current().tables[DELETED] == [] and set(kept) < set(warehouse.current().tables[FACT])
    assert warehouse.contract(FACT).where("NOT holds").isEmpty()


def test_parts_split_as_a_table_grows(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w", part_rows=10)
    load_star(warehouse, sales(spark, *[sale(n, f"O{n}", "2020-05-01", f"C{n}", "P1") for n in range(10)]))
    one = warehouse.current().tables["dim_customer"]
    assert [part_of(f) for f in one] == [1]
    load_star(warehouse, sales(spark, *[sale(n, f"N{n}", "2020-05-01", f"C{n}", "P1") for n in range(5, 60)]))
    many = warehouse.current().tables["dim_customer"]
    assert {depth_of(part_of(f)) for f in many} == {3} and len(many) > 1
    load_star(warehouse, sales(spark, sale(1, "Z", "2020-05-01", "C7", "P1", email="late")))
    last = warehouse.current().tables["dim_customer"]
    assert len(set(many) - set(last)) == 1  # one bounded part is rewritten
    found = {r["customer_id"]: r["email"] for r in warehouse.table("dim_customer").collect()}
    assert len(found) == 60 and found["C7"] == "late"
    assert sorted(r["customer_key"] for r in warehouse.table("dim_customer").collect()) == list(range(1, 61))


def test_numbers_follow_the_places(spark, monkeypatch):
    monkeypatch.setattr(numbering, "STRETCH_BITS", 3)
    rows = [(s, f, b, r, (s + b + r) % 3 != 0) for s in (1, 0) for f in ("b", "a") for b in (100, 0) for r in range(40)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "source int, file string, block long, row long, good boolean")
    df = df.select(F.struct("source", "file", "block", "row").alias("_ord"), "good").repartition(5)
    found = {tuple(r["_ord"]): r["id"] for r in number_placed(df, "id", 7, F.col("good")).collect()}
    good = sorted(r[:4] for r in rows if r[4])
    assert [found[g] for g in good] == list(range(7, 7 + len(good)))
    assert all(found[r[:4]] is None for r in rows if not r[4])


def test_facts_are_numbered_before_their_keys_are_looked_up(spark, tmp_path, monkeypatch):
    plans, number = [], star_load.number_facts

    def seen(lines, start):
        plans.append(lines._jdf.queryExecution().optimizedPlan().toString())
        return number(lines, start)

    monkeypatch.setattr(star_load, "number_facts", seen)
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    load_star(warehouse, sales(spark, *[sale(9 - n, f"O{n}", "2024-01-01", f"C{n % 2}", f"P{n}") for n in range(9)]))
    # A look-up below the numbers would run once for the counts and once for the rows.
    assert len(plans) == 1 and "Join" not in plans[0]
    facts = warehouse.table(FACT).orderBy("sale_id").collect()
    assert [r["order_id"] for r in facts] == [f"O{n}" for n in range(8, -1, -1)]
    assert [r["product_key"] for r in facts] == list(range(1, 10))


def test_a_streams_dates_mean_the_same_in_every_batch(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    batches = [["02/03/2024"], ["nonsense"], ["13/02/2024", "04/05/2024"]]
    for number, days in enumerate(batches):
        loaded = load_star(
            warehouse, sales(spark, *[sale(i, f"O{number}{i}", d, "C1", "P1") for i, d in enumerate(days)]), stream=("s", number)
        )
        assert (loaded is None) == (number == 1)
    # The first batch is read as month/day; so the last is, and its first date is none.
    assert sorted(r["date_key"] for r in warehouse.table(FACT).collect()) == [20240203, 20240405]
    assert warehouse.current().streams == {"s": 2}
    aside = spark.read.parquet(f"{warehouse.root}/_set_aside/s/batch=1")
    assert [r["order_date"] for r in aside.collect()] == ["nonsense"]


@pytest.mark.parametrize("written, key", [
    ("January 5, 2024", 20240105), ("05-Jan-2024", 20240105), ("2024/01/05", 20240105),
    ("2024-01-05T10:00:00", 20240105), ("2024-01-05T23:30:00Z", 20240105),
    ("2024-01-05 23:30:00+05:00", 20240105), ("1/5/2024 11:15 PM", 20240105),
])
def test_dates_follow_the_first_one(spark, tmp_path, written, key):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    loaded = load_star(warehouse, sales(
        spark, sale(1, "O1", written, "C1", "P1"), sale(2, "O2", "never", "C1", "P1"),
    ))
    assert loaded.facts["rows_loaded"] == 1 and loaded.facts["invalid_dates"] == 1
    assert warehouse.table(FACT).first()["date_key"] == key


def test_a_batch_without_readable_dates_fails(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    with pytest.raises(ValueError, match="order_date"):
        load_star(warehouse, sales(spark, sale(1, "O1", "Tuesday", "C1", "P1")))
    assert warehouse.current().version == 0


def test_a_stream_adds_lines_and_passes_over_replays(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    first = sales(spark, sale(1, "O1", "2024-01-05", "C1", "P1"))
    second = sales(spark, sale(1, "O1", "2024-01-05", "C1", "P2"), sale(2, "O2", "2024-01-05", "C1", "P1"))
    assert load_star(warehouse, first, stream=("s", 0)).facts["rows_loaded"] == 1
    assert load_star(warehouse, second, stream=("s", 1)).facts["rows_loaded"] == 2
    assert load_star(warehouse, second, stream=("s", 1)) is None
    assert load_star(warehouse, first, stream=("s", 0)) is None
    assert warehouse.table(FACT).count() == 3


def test_intermediate_tables_are_removed(spark, tmp_path):
    from starmill.workspace import Files, scratch_path, shared_dir

    folder = f"{shared_dir(spark)}/starmill"
    scratch_path(spark, "x")
    before = set(Files(spark).names(folder))
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    load_star(warehouse, sales(spark, sale(1, "O1", "2024-01-01", "C1", "P1")))
    assert set(Files(spark).names(folder)) == before


def test_unmapped_rows_are_dropped_and_counted(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    loaded = load_star(warehouse, sales(
        spark, sale(1, "O1", "2024-01-01", "C1", "P1"), sale(2, "O2", "not a date", "C1", "P1"),
    ))
    assert loaded.facts["rows_loaded"] == 1 and loaded.facts["invalid_dates"] == 1


def test_broken_constraints_leave_the_warehouse_unchanged(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    load_star(warehouse, sales(spark, sale(1, "O1", "2024-01-01", "C1", "P1")))
    bad = sales(spark, sale(1, "O2", "2024-01-01", "C2", "P1", total_amount=-1.0, discount=101.0))
    with pytest.raises(ConstraintError, match="total_amount >= 0 \\(1\\)"):
        load_star(warehouse, bad)
    assert warehouse.current().version == 1 and warehouse.table("dim_customer").count() == 1
    with pytest.raises(ConstraintError, match="customer_id is not null"):
        load_star(warehouse, sales(spark, sale(1, "O2", "2024-01-01", None, "P1")))


def test_concurrent_loads_conflict(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    base = warehouse.current()
    warehouse.publish(base, {}, {})
    with pytest.raises(FileExistsError):
        warehouse.publish(base, {}, {})


def test_of_writers_at_once_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    from starmill.workspace import Files

    files, start = Files(spark), Barrier(6)

    def write(n):
        start.wait()
        try:
            files.create_once(f"file:{tmp_path}/s/1.json", str(n))
            return n
        except FileExistsError:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = [n for n in pool.map(write, range(6)) if n is not None]
    assert len(won) == 1 and files.read_text(f"file:{tmp_path}/s/1.json") == str(won[0])
    assert files.names(f"file:{tmp_path}/s") == ["1.json"]


def test_contract_and_rebuild(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    load_star(warehouse, sales(spark, sale(1, "O1", "2024-01-01", "C1", "P1")))
    base = warehouse.current()
    doubled = base.tables["dim_customer"] * 2
    folder = warehouse.write(warehouse.table("dim_customer"), "dim_customer", 99)
    warehouse.publish(base, {"dim_customer": doubled[:1] + folder}, {})
    with pytest.raises(ContractError, match="unique customer_key"):
        warehouse.require_contract("dim_customer")
    warehouse.rebuild()
    warehouse.require_contract("dim_customer")
    assert warehouse.table(FACT).count() == 0


def test_reports_over_the_star(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    load_star(warehouse, sales(
        spark,
        sale(1, "O1", "2024-03-02", "C1", "P1", total_amount=30.0),
        sale(2, "O2", "2024-03-04", "C2", "P2", category="Home", country="UK"),
        sale(3, "O3", "2024-03-04", "C1", "P2", category="Home"),
    ))
    star = analytics.Star.of(warehouse)
    month = analytics.monthly_revenue(star).collect()
    assert [(r["month_name"], r["transactions"], r["revenue"]) for r in month] == [("March", 3, 66.0)]
    assert [r["customer_id"] for r in analytics.top_customers(star, 1).collect()] == ["C1"]
    kinds = {r["day_type"]: r["transactions"] for r in analytics.weekend_sales(star).collect()}
    assert kinds == {"Weekend": 1, "Weekday": 2}
    segments = {r["customer_segment"]: r["customers"] for r in analytics.segment_revenue(star).collect()}
    assert segments == {"B2B": 1, "B2C": 1}
    view = analytics.sales_analysis(star).where("order_id = 'O1'").first()
    assert view["profit"] == 18.0 and view["discount_amount"] == 2.0


def test_reports_do_not_shuffle_the_fact_for_joins(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    load_star(warehouse, sales(spark, sale(1, "O1", "2024-03-02", "C1", "P1")))
    star = analytics.Star.of(warehouse)
    plan = analytics.category_performance(star)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<product_key:bigint,quantity:bigint,total_amount:double>" in plan
    below_join = plan.split("Join", 1)[1]
    assert "partial_sum(total_amount" in below_join


def test_flat_store(spark, tmp_path):
    store = FlatStore(spark, f"file:{tmp_path}/flat")
    df = spark.createDataFrame([(1, "a", 90.5, "CSV"), (2, "b", 85.0, "JSON")],
                               "id long, name string, score double, _source_type string")
    assert store.load(df, "t") == 2
    assert store.exists("t") and store.row_count("t") == 2
    assert "_source_type" not in store.read("t").columns
    assert store.load(df, "t", "append") == 2
    assert store.row_count("t") == 4
    with pytest.raises(FileExistsError):
        store.load(df, "t", "fail")
    store.load(df, "t", "replace")
    assert store.row_count("t") == 2 and not store.exists("other")


def test_exports(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "hi", ok', datetime(2023, 1, 15), None, "CSV")],
        "id long, name string, at timestamp_ntz, gone string, _source_type string",
    )
    export_csv(df, f"file:{tmp_path}/c")
    back = spark.read.csv(f"file:{tmp_path}/c", header=True, escape='"').first().asDict()
    assert back == {"id": "1", "name": 'say "hi", ok', "at": "2023-01-15 00:00:00", "gone": None,
                    "_source_type": "CSV"}
    export_json(df, f"file:{tmp_path}/j")
    line = spark.read.text(f"file:{tmp_path}/j").first()["value"]
    assert json.loads(line) == {"id": 1, "name": 'say "hi", ok', "at": 1673740800000,
                                "gone": None, "_source_type": "CSV"}


def test_flat_run(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "Order Id,customer,qty,status\nA1,NULL,2,done\nA2,7,x,?\nA1,NULL,2,done\n"
    )
    report = run(spark, {
        "sources": [{"type": "CSV", "path": str(tmp_path / "s.csv")},
                    {"type": "JSON", "path": str(tmp_path / "none.json")}],
        "cleaning": {"null_strategy": "fill", "type_map": {"qty": "int"}},
        "deduplication": {"keep": "first", "use_hash": True},
        "validation_rules": {"status": {"allowed_values": ["done"]}, "qty": {"required": True}},
        "output": {"path": f"file:{tmp_path}/out", "table_name": "t", "export_csv": True,
                   "export_json": True},
    })
    assert report["status"] == "success", report
    assert (report["rows_extracted"], report["rows_loaded"], report["duplicates_removed"]) == (3, 2, 1)
    assert report["validation"]["total_violations"] == 2
    assert len(report["failed_sources"]) == 1
    table = FlatStore(spark, f"file:{tmp_path}/out").read("t")
    assert table.columns == ["order_id", "customer", "qty", "status"]
    assert sorted(r["customer"] for r in table.collect()) == ["7", "Unknown"]
    exported = spark.read.csv(f"file:{tmp_path}/out/t_csv", header=True)
    assert "_row_hash" in exported.columns and "_ord" not in exported.columns


def test_star_run(spark, tmp_path):
    generate_sales(spark, 200).write.csv(f"file:{tmp_path}/in", header=True)
    spec = {
        "use_star_schema": True,
        "sources": [{"type": "CSV", "path": f"file:{tmp_path}/in"}],
        "cleaning": {"null_strategy": "fill", "type_map": {
            "quantity": "int", "unit_price": "float", "discount": "float", "total_amount": "float"}},
        "deduplication": {"subset": ["order_id"]},
        "validation_rules": {"customer_id": {"required": True, "regex": r"^C\d{4}$"}},
        "output": {"path": f"file:{tmp_path}/w"},
    }
    report = run(spark, spec)
    assert report["status"] == "success", report
    assert report["rows_loaded"] == 200 and report["validation"]["passed"]
    assert run(spark, spec)["star"]["facts_replaced"] == 200
    assert Warehouse(spark, f"file:{tmp_path}/w").table(FACT).count() == 200


def test_failed_runs_report_why(spark, tmp_path):
    assert run(spark, {"sources": []})["reason"] == "Empty extract"
    strict = run(spark, {"validation_mode": "strict", "output": {"path": "x"},
                         "sources": [{"type": "CSV", "path": str(tmp_path / "no.csv")}]})
    assert strict["status"] == "failed" and "not found" in strict["error"]


def placed_sales(spark, *rows):
    place = F.struct(F.lit(0).alias("source"), F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.col("_ord.place").cast("long").alias("row"))
    return sales(spark, *rows).withColumn("_ord", place)


def test_rows_are_numbered_without_a_shuffle(spark):
    df = spark.range(30_000).select(
        F.struct(F.lit(0).alias("source"), F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.col("id").alias("row"))
        .alias("_ord"), (F.col("id") % 3 != 0).alias("good"),
    )
    numbered = number_placed(materialize(df, "rows"), "number", 1, F.col("good"))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    found = numbered.where("good").agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(found) == (1, 20_000, 20_000)
    assert numbered.where("good AND number <> _ord.row - _ord.row div 3").isEmpty()


def test_rows_that_share_a_place_get_their_own_numbers(spark):
    rows = [(p, n) for p in (5, 1, 70, 9000) for n in range(2)]
    df = spark.createDataFrame(rows, "row long, n int").select(
        F.struct(F.lit(0).alias("source"), F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), "row").alias("_ord"),
    )
    found = sorted((r["number"], r["_ord"]["row"]) for r in number_placed(df, "number", 1, F.lit(True)).collect())
    assert found == list(enumerate([1, 1, 5, 5, 70, 70, 9000, 9000], 1))


def test_first_rows_are_found_without_sorting_all_rows(spark):
    df = placed_sales(
        spark,
        sale(2, "O2", "2024-01-15", "C1", "P1", email="new", unit_price=11.11),
        sale(1, "O1", "2024-03-01", "C1", "P1", email="old", unit_price=10.0),
        sale(9000, "O3", "2024-02-01", "C2", "P1", unit_price=10.0),
    )
    by_place = numbering.with_places(df, "_ord")
    for dimension in (customer_dimension, product_dimension):
        found = dimension(by_place)
        assert sorted(map(tuple, found.drop("_ord").collect())) == sorted(map(tuple, dimension(df).drop("_ord").collect()))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate")


def test_keys_are_looked_up_in_written_dimensions(spark, tmp_path):
    warehouse = Warehouse(spark, f"file:{tmp_path}/w")
    rows = materialize(placed_sales(spark, *[sale(n, f"O{n}", "2024-01-01", f"C{n % 3}", f"P{n % 2}") for n in range(6)]), "sales")
    loaded = star_load.load_dimension(
        warehouse, warehouse.current(), "dim_customer", customer_dimension(rows), datetime(2024, 1, 1)
    )
    assert sorted(tuple(r) for r in loaded.rows.select("customer_key", "customer_id").collect()) == [(1, "C0"), (2, "C1"), (3, "C2")]
    files = loaded.rows.inputFiles()
    assert files and all(f"/dim_customer/{loaded.folders[0].split('/')[1]}/" in f for f in files)


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_written_tables_and_loads_leave_no_shuffle_files(spark, tmp_path):
    setting = spark.conf.get(FILE_CLEANUP, None)
    before = shuffle_files(spark)
    materialize(spark.range(1000).repartition(7).groupBy(F.col("id") % 10).count(), "counts")
    assert not shuffle_files(spark) - before
    batch = [sale(n, f"O{n // 2}", f"2024-01-0{1 + n}", f"C{n % 3}", f"P{n % 4}") for n in range(8)]
    loaded = load_star(Warehouse(spark, f"file:{tmp_path}/wh"), sales(spark, *batch))
    assert loaded.facts["rows_loaded"] == 8 and not shuffle_files(spark) - before
    assert spark.conf.get(FILE_CLEANUP, None) == setting


def test_the_switch_for_shuffle_files_is_as_it_was(spark):
    spark.conf.set(FILE_CLEANUP, "false")
    try:
        with pytest.raises(ZeroDivisionError), shuffles_dropped(spark), shuffles_dropped(spark):
            assert spark.conf.get(FILE_CLEANUP) == "true"
            1 / 0
        assert spark.conf.get(FILE_CLEANUP) == "false"
    finally:
        spark.conf.unset(FILE_CLEANUP)
    # What is read again after its shuffle is gone is still whole.
    with shuffles_dropped(spark):
        df = spark.range(100).repartition(3).groupBy(F.col("id") % 4).count()
    assert [len(df.collect()) for _ in range(3)] == [4, 4, 4]
