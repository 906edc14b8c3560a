"""Queries of the dimension builders and the lookups they share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.calendar import calendar_columns
from starmill.functions.customers import region_of, segment_of
from starmill.operators.dimensions import (
    CUSTOMER_COLUMNS,
    PRODUCT_COLUMNS,
    customer_dimension,
    date_dimension,
    date_dimension_for,
    first_rows,
    product_dimension,
)
from starmill.registry.tables import (
    B2B,
    DIMENSIONS,
    REGION_SQL,
    REGIONS,
    SALES,
    SEGMENT_SQL,
    STAR,
    sales,
    table,
)

WITH_SALES = f"WITH {SALES}"


def first_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First seen attributes, from sales whose customers move: the city of each sale differs."""
    rows = sales(spark, sf_dir).withColumn("city", F.col("product_name"))
    return first_rows(rows, "customer_id", CUSTOMER_COLUMNS).drop("_ord")


FIRST_CUSTOMERS = f"""{WITH_SALES}
SELECT customer_id, customer_name, email, country, product_name AS city FROM sales
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ord) = 1"""


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    nations = rows.select("n_name", "n_nationkey", region_of(F.col("r_name"), REGIONS).alias("region"))
    buyers = table(spark, sf_dir, "customer")
    return buyers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        "n_name", "region"
    ).agg(F.count("*").alias("customers"))


REGIONS_SQL = f"""
SELECT n_name, {REGION_SQL.replace('country', 'r_name')} AS region, count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return rows.select("c_custkey", segment_of(F.col("r_name"), B2B).alias("customer_segment"))


SEGMENTS_SQL = f"""
SELECT c_custkey, {SEGMENT_SQL.replace('country', 'r_name')} AS customer_segment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_dimension(sales(spark, sf_dir), REGIONS, B2B).drop("_ord")


CUSTOMERS = STAR + "SELECT * EXCLUDE (customer_key) FROM dim_customer"


def first_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(sales(spark, sf_dir), "product_id", PRODUCT_COLUMNS).drop("_ord")


FIRST_PRODUCTS = f"""{WITH_SALES}
SELECT product_id, product_name, category, subcategory, brand FROM sales
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ord) = 1"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With prices that differ from sale to sale, so the mean matters."""
    rows = sales(spark, sf_dir).withColumn("unit_price", F.col("total_amount"))
    return product_dimension(rows).drop("_ord")


PRODUCTS = f"""WITH {SALES.replace('sales AS', 'listed AS', 1)},
sales AS (SELECT * REPLACE (total_amount AS unit_price) FROM listed), {DIMENSIONS}
SELECT * EXCLUDE (product_key) FROM dim_product"""


def active_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = product_dimension(sales(spark, sf_dir))
    return rows.groupBy("is_active").agg(F.count("*").alias("products"))


ACTIVE_PRODUCTS = f"""{WITH_SALES}
SELECT 1 AS is_active, count(DISTINCT product_id) AS products FROM sales"""


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension_for(
        table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("order_date"))
    )


DATES = STAR + "SELECT * FROM dim_date"


def calendar_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar attributes of every order's day, computed on the orders themselves."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in calendar_columns(day).items()]
    )


def _calendar_sql(columns: str) -> str:
    return f"""WITH {SALES}, {DIMENSIONS}
SELECT o_orderkey, {columns} FROM orders JOIN dim_date ON CAST(o_orderdate AS DATE) = full_date"""


def fiscal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calendar_of_orders(spark, sf_dir)
    return rows.groupBy("fiscal_year", "fiscal_quarter").agg(F.count("*").alias("orders"))


FISCAL = """
SELECT CAST(CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate)
                 ELSE year(o_orderdate) - 1 END AS INTEGER) AS fiscal_year,
       CAST(CASE WHEN month(o_orderdate) >= 7 THEN (month(o_orderdate) - 7) // 3 + 1
                 ELSE (month(o_orderdate) + 5) // 3 + 1 END AS INTEGER) AS fiscal_quarter,
       count(*) AS orders
FROM orders GROUP BY ALL"""


def explicit_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An explicit range, with the orders of each day."""
    days = date_dimension(spark, "1996-02-01", "1996-03-31")
    orders = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderdate").cast("date").alias("full_date")
    ).agg(F.count("*").alias("orders"))
    return days.join(orders, "full_date", "left").select("date_key", "day_of_week", "orders")


EXPLICIT_DATES = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, dayname(d) AS day_of_week, orders
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1996-02-01', TIMESTAMP '1996-03-31',
                                         INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)
USING (d)"""


QUERIES = {
    "dim_1": (first_customers, FIRST_CUSTOMERS),
    "dim_2": (regions, REGIONS_SQL),
    "dim_3": (segments, SEGMENTS_SQL),
    "dim_4": (customers, CUSTOMERS),
    "dim_5": (first_products, FIRST_PRODUCTS),
    "dim_6": (products, PRODUCTS),
    "dim_7": (active_products, ACTIVE_PRODUCTS),
    "dim_8": (dates, DATES),
    "dim_8_range": (explicit_dates, EXPLICIT_DATES),
    "dim_9": (calendar_of_orders, _calendar_sql("dim_date.*")),
    "dim_10": (fiscal, FISCAL),
}
