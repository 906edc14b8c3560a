"""Queries of the loads: flat tables, dimensions, facts and the whole star."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.dimensions import customer_dimension, date_dimension_for
from starmill.operators.numbering import number_rows
from starmill.operators.sinks import FlatStore, export_csv, export_json
from starmill.plans.star_load import (
    first_load,
    load_measures,
    load_star,
    new_dates,
    number_facts,
    resolve_facts,
    upsert,
)
from starmill.plans.warehouse import FACT, Warehouse, constraint_counts
from starmill.registry.tables import (
    B2B,
    DIMENSIONS,
    MONEY,
    REGION_SQL,
    REGIONS,
    SALES,
    SALES_BY_KEY,
    SEGMENT_SQL,
    STAR,
    loaded_warehouse,
    once,
    sales,
    table,
    written_sales,
)
from starmill.workspace import materialize, scratch_path

FIRST, SECOND = datetime(2026, 1, 1), datetime(2026, 1, 2)


def flat_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace, then append; the store drops lineage columns."""
    store = FlatStore(spark, scratch_path(spark, "flat"))
    customers = table(spark, sf_dir, "customer").withColumn("_source_type", F.lit("SQL"))
    store.load(customers, "customers", "replace")
    store.load(customers.where("c_acctbal < 0"), "customers", "append")
    return store.read("customers")


FLAT_LOAD = "SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_acctbal < 0"


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.when(F.col("lang") != "en", F.col("lang")).alias("lang"),
        F.lit("documents").alias("_source_file"),
    )
    export_csv(docs, path)
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


CSV_EXPORT = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, nullif(lang, 'en') AS lang,
       'documents' AS _source_file FROM documents"""


def json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read back: dates are milliseconds, nulls are written."""
    path = scratch_path(spark, "export")
    export_json(
        table(spark, sf_dir, "events").select(
            "event_id", "ts", F.col("ts").cast("date").alias("day"),
            F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        ),
        path,
    )
    return spark.read.schema("event_id long, ts long, day long, value double").json(path)


JSON_EXPORT = """
SELECT event_id, epoch_us(ts) // 1000 AS ts, epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS day,
       CASE WHEN event_type <> 'error' THEN value END AS value
FROM events"""


def store_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = FlatStore(spark, scratch_path(spark, "flat"))
    store.load(table(spark, sf_dir, "orders"), "orders", "fail")
    try:
        store.load(table(spark, sf_dir, "orders"), "orders", "fail")
        refused = False
    except FileExistsError:
        refused = True
    return store.read("orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders")).select(
        "*",
        F.lit(store.exists("orders")).alias("found"),
        F.lit(store.exists("nothing")).alias("other_found"),
        F.lit(store.row_count("orders")).cast("long").alias("row_count"),
        F.lit(refused).alias("second_refused"),
    )


STORE_FACTS = """
SELECT o_orderstatus, count(*) AS orders, true AS found, false AS other_found,
       (SELECT count(*) FROM orders) AS row_count, true AS second_refused
FROM orders GROUP BY o_orderstatus"""


def dates_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days a second batch adds to the calendar of the first."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("order_date"))
    first = date_dimension_for(orders.where("order_date < '1998-01-01'"))
    return new_dates(first, date_dimension_for(orders))


DATES_ADDED = STAR + "SELECT * FROM dim_date WHERE year >= 1998"


def two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sales up to 1997, and from mid-1997 on under new addresses."""
    rows = written_sales(spark, sf_dir)
    later = rows.where("order_date >= '1997-07-01'").withColumn(
        "email", F.replace("email", F.lit("@email.com"), F.lit("@mail.org"))
    )
    return rows.where("order_date < '1998-01-01'"), later


BATCHES = f"""{SALES},
b1 AS (SELECT * FROM sales WHERE order_date < DATE '1998-01-01'),
b2 AS (SELECT * REPLACE (replace(email, '@email.com', '@mail.org') AS email)
       FROM sales WHERE order_date >= DATE '1997-07-01'),
c1 AS (SELECT *, row_number() OVER (ORDER BY ord) AS customer_key FROM
       (SELECT * FROM b1 QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ord) = 1)),
c2 AS (SELECT * FROM b2 QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ord) = 1),
n2 AS (SELECT *, (SELECT count(*) FROM c1) + row_number() OVER (ORDER BY ord) AS customer_key
       FROM c2 WHERE customer_id NOT IN (SELECT customer_id FROM c1)),
m1 AS (SELECT customer_id, min(order_date) AS d FROM b1 GROUP BY 1),
m2 AS (SELECT customer_id, min(order_date) AS d FROM b2 GROUP BY 1),
customers AS (
  SELECT c1.customer_key, customer_id, coalesce(c2.customer_name, c1.customer_name)
           AS customer_name, coalesce(c2.email, c1.email) AS email,
         coalesce(c2.country, c1.country) AS country, coalesce(c2.city, c1.city) AS city,
         coalesce(m2.d, m1.d) AS first_purchase_date, TIMESTAMP '2026-01-01' AS loaded_at,
         CASE WHEN c2.customer_id IS NULL THEN TIMESTAMP '2026-01-01'
              ELSE TIMESTAMP '2026-01-02' END AS updated_at,
         CASE WHEN c2.customer_id IS NULL THEN 'kept' ELSE 'updated' END AS _change
  FROM c1 LEFT JOIN c2 USING (customer_id) LEFT JOIN m1 USING (customer_id)
  LEFT JOIN m2 USING (customer_id)
  UNION ALL
  SELECT n2.customer_key, customer_id, customer_name, email, country, city, m2.d,
         TIMESTAMP '2026-01-02', TIMESTAMP '2026-01-02', 'new'
  FROM n2 JOIN m2 USING (customer_id))"""


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension after two batches."""
    before, after = two_batches(spark, sf_dir)
    columns = Warehouse(spark, "", MONEY).schemas["dim_customer"].names
    current = materialize(
        first_load(customer_dimension(before, REGIONS, B2B), columns, "customer_key", FIRST)
        .drop("_change"),
        "first",
    )
    batch = customer_dimension(after, REGIONS, B2B)
    return upsert(
        current, batch, "customer_id", "customer_key", SECOND, current.count() + 1
    )


UPSERTED = f"""WITH {BATCHES}
SELECT *, {REGION_SQL} AS region, {SEGMENT_SQL} AS customer_segment FROM customers"""


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys in order of first appearance."""
    lines = table(spark, sf_dir, "lineitem")
    firsts = lines.groupBy("l_partkey").agg(F.min(F.struct("l_shipdate", "l_orderkey")).alias("seen"))
    return number_rows(firsts, ["seen", "l_partkey"], "part_key", 1001).drop("seen")


SURROGATE_KEYS = """
WITH firsts AS (SELECT l_partkey, l_shipdate, l_orderkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey) = 1)
SELECT l_partkey, 1000 + row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_partkey) AS part_key
FROM firsts"""


def partly_mapped(spark: SparkSession, sf_dir: str, by_key: bool = False) -> DataFrame:
    """Facts against key maps that lack customers in debt and large parts; some dates unreadable."""
    customers = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        F.concat(F.lit("C"), F.lpad(
            F.col("c_custkey").cast("string"),
            F.greatest(F.length(F.col("c_custkey").cast("string")), F.lit(6)), F.lit("0"),
        )).alias("customer_id"),
        F.col("c_custkey").alias("customer_key"),
    )
    products = table(spark, sf_dir, "part").where("p_size <= 45").select(
        F.concat(F.lit("P"), F.lpad(
            F.col("p_partkey").cast("string"),
            F.greatest(F.length(F.col("p_partkey").cast("string")), F.lit(6)), F.lit("0"),
        )).alias("product_id"),
        F.col("p_partkey").alias("product_key"),
    )
    rows = sales(spark, sf_dir, by_key).withColumn(
        "order_date",
        F.when(F.col("quantity") == 50, "unknown").otherwise(F.col("order_date").cast("string")),
    )
    return resolve_facts(rows, customers, products)


def facts_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts numbered in one order of all lines, wherever their file has them."""
    facts = number_facts(partly_mapped(spark, sf_dir, by_key=True))
    return facts.where("_dropped IS NULL").drop("_dropped", "_ord").withColumns({
        c: F.col(c).cast("long") for c in ("quantity",)
    })


MAPPED = f"""{SALES},
mapped AS (
  SELECT CASE WHEN quantity <> 50 THEN CAST(strftime(order_date, '%Y%m%d') AS INTEGER) END
           AS date_key,
         c_custkey AS customer_key, p_partkey AS product_key, order_id,
         CAST(quantity AS BIGINT) AS quantity, unit_price, discount, total_amount, ord
  FROM sales
  LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0)
    ON CAST(substr(customer_id, 2) AS BIGINT) = c_custkey
  LEFT JOIN (SELECT * FROM part WHERE p_size <= 45)
    ON CAST(substr(product_id, 2) AS BIGINT) = p_partkey)"""

FACTS_LOADED = f"""WITH {MAPPED.replace(SALES, SALES_BY_KEY)}
SELECT * EXCLUDE (ord), row_number() OVER (ORDER BY ord) AS sale_id FROM mapped
WHERE customer_key IS NOT NULL AND product_key IS NOT NULL AND date_key IS NOT NULL"""


def facts_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = partly_mapped(spark, sf_dir).agg(*[c.alias(n) for n, c in load_measures().items()])
    return counts.withColumn("total_revenue", F.col("total_revenue").cast("decimal(28,2)"))


FACTS_COUNTED = f"""WITH {MAPPED},
kept AS (SELECT * FROM mapped
         WHERE customer_key IS NOT NULL AND product_key IS NOT NULL AND date_key IS NOT NULL)
SELECT count(*) AS rows_in,
       count(*) FILTER (WHERE customer_key IS NULL) AS unmapped_customers,
       count(*) FILTER (WHERE customer_key IS NOT NULL AND product_key IS NULL)
         AS unmapped_products,
       count(*) FILTER (WHERE customer_key IS NOT NULL AND product_key IS NOT NULL
                          AND date_key IS NULL) AS invalid_dates,
       (SELECT count(*) FROM kept) AS rows_loaded,
       (SELECT CAST(sum(total_amount) AS DECIMAL(28,2)) FROM kept) AS total_revenue,
       (SELECT CAST(CAST(sum(total_amount) AS DECIMAL(28,2)) AS DOUBLE) / count(*) FROM kept)
         AS avg_order
FROM mapped"""


def constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts bent until they break the table's constraints."""
    facts = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sale_id"),
        F.lit(20200101).alias("date_key"),
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("customer_key"),
        F.col("l_partkey").alias("product_key"),
        F.when(F.col("l_linestatus") == "F", F.lit("x")).alias("order_id"),
        (F.col("l_quantity") - 5).alias("quantity"),
        (F.col("l_extendedprice") - 1000).alias("unit_price"),
        (F.col("l_discount") * 2000 - 1).alias("discount"),
        F.col("l_extendedprice").alias("total_amount"),
    )
    return constraint_counts(facts, FACT)


_BROKEN = {
    "sale_id is not null": "l_orderkey IS NULL",
    "date_key is not null": "false",
    "customer_key is not null": "l_returnflag = 'R' OR l_suppkey IS NULL",
    "product_key is not null": "l_partkey IS NULL",
    "order_id is not null": "l_linestatus <> 'F'",
    "quantity is not null": "l_quantity IS NULL",
    "unit_price is not null": "l_extendedprice IS NULL",
    "total_amount is not null": "l_extendedprice IS NULL",
    "quantity > 0": "l_quantity - 5 <= 0",
    "unit_price >= 0": "l_extendedprice - 1000 < 0",
    "discount between 0 and 100": "l_discount * 2000 - 1 < 0 OR l_discount * 2000 - 1 > 100",
    "total_amount >= 0": "l_extendedprice < 0",
}
CONSTRAINTS = " UNION ALL ".join(
    f"SELECT '{name}' AS constraint_name, count(*) AS violations FROM lineitem WHERE {rule}"
    for name, rule in _BROKEN.items()
)


def reloaded_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse after two overlapping batches."""
    def load() -> Warehouse:
        warehouse = Warehouse(spark, scratch_path(spark, "warehouse"), MONEY)
        for batch, now in zip(two_batches(spark, sf_dir), (FIRST, SECOND)):
            load_star(warehouse, batch, REGIONS, B2B, now)
        return warehouse

    return once(spark, sf_dir, "reloaded", load)


def facts_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = reloaded_warehouse(spark, sf_dir).table(FACT)
    return facts.select(
        "sale_id", "date_key", "customer_key", "order_id", "quantity", "total_amount", "loaded_at"
    )


FACTS_RELOADED = f"""WITH {BATCHES},
f1 AS (SELECT *, row_number() OVER (ORDER BY ord) AS sale_id FROM b1),
f2 AS (SELECT *, (SELECT count(*) FROM b1) + row_number() OVER (ORDER BY ord) AS sale_id FROM b2),
facts AS (
  SELECT *, TIMESTAMP '2026-01-01' AS loaded_at FROM f1
  WHERE order_id NOT IN (SELECT order_id FROM b2)
  UNION ALL SELECT *, TIMESTAMP '2026-01-02' FROM f2)
SELECT sale_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, customer_key,
       order_id, CAST(quantity AS BIGINT) AS quantity, total_amount, facts.loaded_at
FROM facts JOIN (SELECT customer_id, customer_key FROM customers) USING (customer_id)"""


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = loaded_warehouse(spark, sf_dir).table(FACT)
    revenue = F.sum("total_amount").cast("decimal(28,2)")
    return facts.agg(
        revenue.alias("total_revenue"),
        (revenue.cast("double") / F.count("total_amount")).alias("avg_order"),
    )


LOAD_SUMMARY = f"""WITH {SALES}
SELECT CAST(sum(total_amount) AS DECIMAL(28,2)) AS total_revenue,
       CAST(CAST(sum(total_amount) AS DECIMAL(28,2)) AS DOUBLE) / count(total_amount) AS avg_order
FROM sales"""


def star_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole star load into a new warehouse, as rows per table and orphans per key."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"), MONEY)
    rows = materialize(sales(spark, sf_dir), "sales")
    loaded = load_star(warehouse, rows, REGIONS, B2B)
    out = None
    for name in ("dim_date", "dim_customer", "dim_product", FACT):
        one = warehouse.table(name).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out.withColumn("orphans", F.lit(sum(loaded.orphans.values())))


STAR_LOAD = STAR + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, CAST(0 AS INTEGER) AS orphans FROM {n}"
    for n in ("dim_date", "dim_customer", "dim_product", FACT)
)


def contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and key uniqueness of the stored tables."""
    warehouse = loaded_warehouse(spark, sf_dir)
    out = None
    for name in ("dim_customer", FACT):
        one = warehouse.contract(name)
        out = one if out is None else out.unionByName(one)
    return out


CONTRACT = STAR + """
SELECT 'dim_customer' AS table_name, 'columns' AS promise, true AS holds, '' AS detail
UNION ALL SELECT 'dim_customer', 'unique customer_key', true,
       concat('dim_customer: ✓ All ', count(*), ' keys are unique') FROM dim_customer
UNION ALL SELECT 'dim_customer', 'unique customer_id', true,
       concat('dim_customer: ✓ All ', count(*), ' keys are unique') FROM dim_customer
UNION ALL SELECT 'fact_sales', 'columns', true, ''
UNION ALL SELECT 'fact_sales', 'unique sale_id', true,
       concat('fact_sales: ✓ All ', count(*), ' keys are unique') FROM fact_sales"""


def stored_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_warehouse(spark, sf_dir).table(FACT).drop("loaded_at", "sale_year")


STORED_FACTS = STAR + "SELECT * FROM fact_sales"

QUERIES = {
    "lod_1": (flat_load, FLAT_LOAD),
    "lod_2": (csv_export, CSV_EXPORT),
    "lod_3": (json_export, JSON_EXPORT),
    "lod_4": (store_facts, STORE_FACTS),
    "lod_5": (dates_added, DATES_ADDED),
    "lod_6": (upserted, UPSERTED),
    "lod_7": (surrogate_keys, SURROGATE_KEYS),
    "lod_8": (facts_loaded, FACTS_LOADED),
    "lod_8_counts": (facts_counted, FACTS_COUNTED),
    "lod_9": (constraints, CONSTRAINTS),
    "lod_10": (facts_reloaded, FACTS_RELOADED),
    "lod_11": (load_summary, LOAD_SUMMARY),
    "lod_12": (star_load, STAR_LOAD),
    "lod_12_facts": (stored_facts, STORED_FACTS),
    "lod_13": (contract, CONTRACT),
}
