"""Queries of the quality and profile reports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators import profile
from starmill.plans.run import run
from starmill.plans.warehouse import FACT
from starmill.registry.scans import csv_of
from starmill.registry.tables import MONEY, STAR, dirty_orders, loaded_warehouse, star, table
from starmill.workspace import scratch_path


def gappy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items without the columns that tell repeated ones apart, some cells null."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("l_quantity"),
    )


GAPPY = """
lines AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS l_returnflag,
                 CASE WHEN l_quantity > 10 THEN l_quantity END AS l_quantity FROM lineitem)"""


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.quality_report(gappy_lines(spark, sf_dir))


def _columns_sql(source: str, types: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, "
        f"count(*) - count({c}) AS null_count, count(*) AS total_rows FROM {source}"
        for c, t in types.items()
    )


_LINE_TYPES = {
    "l_orderkey": "bigint", "l_linenumber": "int", "l_returnflag": "string", "l_quantity": "double",
}
QUALITY = f"""
WITH {GAPPY}, per_column AS ({_columns_sql('lines', _LINE_TYPES)})
SELECT column_name, data_type, null_count,
       round_even(null_count / total_rows * 100 * 100, 0) / 100 AS null_percent,
       total_rows, 4 AS total_columns,
       total_rows - (SELECT count(*) FROM (SELECT DISTINCT * FROM lines)) AS duplicate_rows
FROM per_column"""


def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_profile(gappy_lines(spark, sf_dir))


STORED_PROFILE = f"""
WITH {GAPPY}, per_column AS ({_columns_sql('lines', _LINE_TYPES)})
SELECT column_name, data_type, null_count, total_rows, 4 AS total_columns,
       CAST((SELECT sum(null_count) FROM per_column) AS BIGINT) AS total_nulls
FROM per_column"""


def dimension_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal",
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"),
    )
    return profile.dimension_stats(rows, "customers")


DIMENSION_STATISTICS = """
WITH rows AS (SELECT c_custkey, c_name, c_acctbal,
                     CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segment FROM customer)
SELECT 'customers' AS dimension, count(*) AS row_count, 4 AS column_count,
       'c_custkey,c_name,c_acctbal,segment' AS columns,
       concat('c_custkey=', count(*) - count(c_custkey), ',c_name=', count(*) - count(c_name),
              ',c_acctbal=', count(*) - count(c_acctbal), ',segment=', count(*) - count(segment))
         AS null_counts,
       round_even(CAST(sum(16 + octet_length(encode(c_name))
                           + coalesce(octet_length(encode(segment)), 0)) AS DOUBLE)
                  / 1048576 * 100, 0) / 100 AS memory_mb
FROM rows"""


def breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, suppliers and parts as three kinds of source."""
    kinds = {"customer": "CSV", "supplier": "JSON", "part": "SQL"}
    rows = None
    for name, kind in kinds.items():
        one = table(spark, sf_dir, name).select(F.lit(kind).alias("_source_type"))
        rows = one if rows is None else rows.unionByName(one)
    return profile.source_breakdown(rows)


BREAKDOWN = """
SELECT 'CSV' AS _source_type, count(*) AS row_count FROM customer
UNION ALL SELECT 'JSON', count(*) FROM supplier
UNION ALL SELECT 'SQL', count(*) FROM part"""


def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = profile.uniqueness(table(spark, sf_dir, "orders"), "o_orderkey", "orders")
    bad = profile.uniqueness(table(spark, sf_dir, "lineitem"), "l_orderkey", "lines")
    return good.unionByName(bad)


UNIQUE_KEYS = """
SELECT 'orders' AS dimension, count(*) AS total_rows, count(DISTINCT o_orderkey) AS unique_keys,
       true AS is_valid, concat('orders: ✓ All ', count(*), ' keys are unique') AS message
FROM orders
UNION ALL
SELECT 'lines', count(*), count(DISTINCT l_orderkey), false,
       concat('lines: ', count(*) - count(DISTINCT l_orderkey),
              ' duplicate keys found in l_orderkey')
FROM lineitem"""


def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded star, against whole dimensions and against some that lost rows."""
    s = star(spark, sf_dir)
    return profile.referential_orphans(s.fact, {
        "customer_key": s.customers.where("customer_segment = 'B2B'"),
        "product_key": s.products,
        "date_key": s.dates.where("is_weekend = 0"),
    })


INTEGRITY = STAR + """
SELECT 'customer_key' AS foreign_key, count(*) AS orphans FROM fact_sales
WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer WHERE customer_segment = 'B2B')
UNION ALL
SELECT 'product_key', count(*) FROM fact_sales
WHERE product_key NOT IN (SELECT product_key FROM dim_product)
UNION ALL
SELECT 'date_key', count(*) FROM fact_sales
WHERE date_key NOT IN (SELECT date_key FROM dim_date WHERE is_weekend = 0)"""


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = loaded_warehouse(spark, sf_dir)
    tables = [profile.table_info(warehouse.table(n), n) for n in ("dim_product", FACT)]
    return tables[0].unionByName(tables[1])


def _info_sql(name: str, columns: str) -> str:
    pairs = [c.split(":") for c in columns.split()]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS row_count, "
        f"{i + 1} AS position, '{c}' AS column_name, '{t}' AS column_type"
        for i, (c, t) in enumerate(pairs)
    )


INFO = STAR + " UNION ALL ".join([
    _info_sql(
        "dim_product",
        "product_key:bigint product_id:string product_name:string category:string "
        f"subcategory:string brand:string cost_price:{MONEY} is_active:int "
        "loaded_at:timestamp_ntz updated_at:timestamp_ntz",
    ),
    _info_sql(
        FACT,
        "sale_id:bigint date_key:int customer_key:bigint product_key:bigint order_id:string "
        f"quantity:bigint unit_price:{MONEY} discount:{MONEY} total_amount:{MONEY} "
        "loaded_at:timestamp_ntz sale_year:int",
    ),
])


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row counts a whole flat run reports; its seconds vary from run to run."""
    source = csv_of(dirty_orders(spark, sf_dir).drop("_ord"), scratch_path(spark, "csv"))
    report = run(spark, {
        "sources": [{"type": "CSV", "path": source}],
        "cleaning": {"null_strategy": "fill", "type_map": {"units": "int", "rush_": "bool"}},
        "deduplication": {"keep": "first", "subset": ["order_date", "order_status"]},
        "validation_rules": {"units": {"min_value": 10}, "order_status": {"required": True}},
        "output": {"path": scratch_path(spark, "flat"), "table_name": "orders"},
    })
    row = (
        report["rows_extracted"], report["rows_cleaned"], report["duplicates_removed"],
        report["rows_loaded"], report["validation"]["total_violations"],
    )
    return spark.createDataFrame(
        [row],
        "rows_extracted long, rows_cleaned long, duplicates_removed long, rows_loaded long, "
        "total_violations int",
    )


RUN_COUNTS = """
WITH keyed AS (SELECT DISTINCT o_orderstatus,
                 CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'not a date'
                      ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS bought FROM orders)
SELECT (SELECT count(*) FROM orders) AS rows_extracted,
       (SELECT count(*) FROM orders) AS rows_cleaned,
       (SELECT count(*) FROM orders) - (SELECT count(*) FROM keyed) AS duplicates_removed,
       (SELECT count(*) FROM keyed) AS rows_loaded,
       CAST((SELECT count(*) > 0 FROM orders
             WHERE o_orderstatus <> 'F' AND floor(o_totalprice / 1000) < 10) AS INTEGER)
         AS total_violations"""


QUERIES = {
    "qlt_1": (quality, QUALITY),
    "qlt_2": (stored_profile, STORED_PROFILE),
    "qlt_3": (dimension_statistics, DIMENSION_STATISTICS),
    "qlt_4": (breakdown, BREAKDOWN),
    "qlt_5": (unique_keys, UNIQUE_KEYS),
    "qlt_6": (integrity, INTEGRITY),
    "qlt_7": (info, INFO),
    "qlt_9": (run_counts, RUN_COUNTS),
}
