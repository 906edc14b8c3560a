"""Streams over files that arrive one by one."""

from datetime import date, datetime

from pyspark.sql import functions as F

from starmill.plans import star_load
from starmill.registry import streams
from starmill.plans.warehouse import Warehouse
from starmill.sources.order import place
from starmill.streaming.ingest import publish_stream, published_totals, stream_load, stream_totals
from starmill.workspace import Files, shared_dir


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, "at timestamp, amount long").coalesce(1).write.mode("append").parquet(folder)


def test_totals_are_final_and_their_state_is_dropped(spark, tmp_path):
    folder, out, state = (f"file:{tmp_path}/{name}" for name in ("in", "out", "state"))

    def run():
        rows = spark.readStream.schema("at timestamp, amount long").parquet(folder)
        query = publish_stream(stream_totals(rows, "at", "amount"), out, state)
        query.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]

    for day in range(1, 8):
        arrive(spark, folder, [(datetime(2024, 1, day, 12), 1), (datetime(2024, 1, day, 13), 1)])
        kept = run()
    assert max(kept) <= 4
    arrive(spark, folder, [(datetime(2024, 1, 2, 12), 100), (datetime(2024, 1, 7, 14), 5)])
    run()
    totals = {r["period"].day: (r["transactions"], r["revenue"]) for r in published_totals(spark, out).collect()}
    assert totals == {day: (2, 2) for day in range(1, 7)} | {7: (3, 7)}


def test_files_of_a_stream_have_a_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "ARRIVAL_ROWS", 100)
    rows = spark.range(2000).select(F.struct("id").alias("_ord"))
    files = streams.arrivals(rows, f"file:{tmp_path}/in", 3)
    written = spark.read.parquet(f"file:{tmp_path}/in")
    sizes = [r["count"] for r in written.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert files == 7 and len(sizes) == 21 and sum(sizes) == 2000 and max(sizes) < 200


def test_csv_files_that_a_stream_reads_whole_have_a_bounded_size(spark, sf_dir, monkeypatch, tmp_path):
    monkeypatch.setattr(streams, "CSV_ROWS", 400)
    seen = []
    write = streams.csv_of
    monkeypatch.setattr(streams, "csv_of", lambda *args: seen.append(write(*args)) or seen[0])
    found = streams.cleaned_stream(spark, sf_dir)
    files = spark.read.text(seen[0]).groupBy(F.col("_metadata.file_name")).count().collect()
    assert max(r["count"] for r in files) <= 401 and found.count() == sum(r["count"] - 1 for r in files)


def test_lines_of_a_stream_are_numbered_by_their_places(spark, sf_dir, tmp_path, monkeypatch):
    sorted_rows = []
    numbered = star_load.number_rows
    monkeypatch.setattr(star_load, "number_rows", lambda df, order, into, *args: sorted_rows.append(into) or numbered(df, order, into, *args))
    lines = [
        (f"O{n % 4}", date(2024, 1, 1 + n), f"C{n % 3}", "a", "a@x", "Spain", "Madrid", f"P{n % 2}", "thing", "Books", "Tech", "B",
         1, 2.0, 0.0, 2.0, (7 * n) % 10) for n in range(10)
    ]
    rows = spark.createDataFrame(
        lines, "order_id string, order_date date, customer_id string, customer_name string, email string, country string, "
        "city string, product_id string, product_name string, category string, subcategory string, brand string, "
        "quantity long, unit_price double, discount double, total_amount double, at long",
    ).withColumn("place", place(0, F.lit("f"), F.lit(0), F.col("at"))).drop("at")
    rows.coalesce(1).write.parquet(f"file:{tmp_path}/in")
    warehouse = Warehouse(spark, f"file:{tmp_path}/wh")
    stream = spark.readStream.schema(rows.schema).parquet(f"file:{tmp_path}/in")
    stream_load(stream, warehouse, f"file:{tmp_path}/state", ["place"]).awaitTermination()
    assert sorted(sorted_rows) == ["customer_key", "product_key"]  # the dimensions only
    facts = sorted((r.sale_id, r.date_key) for r in warehouse.table("fact_sales").collect())
    days = {(7 * n) % 10: 20240101 + n for n in range(10)}
    assert facts == [(k + 1, days[k]) for k in range(10)]


def test_what_arrives_is_removed_once_it_is_loaded(spark, sf_dir):
    streams.written_sales(spark, sf_dir)
    files = Files(spark)
    before = set(files.names(f"{shared_dir(spark)}/starmill"))
    assert streams.loaded_stream(spark, sf_dir).count()
    left = {n.rsplit("-", 1)[0] for n in set(files.names(f"{shared_dir(spark)}/starmill")) - before}
    assert left <= {"warehouse", "state"}
