"""The given tables, and the shapes the registered queries make of them.

Every shape exists twice: as a DataFrame, and as a common table expression for
the SQL that checks it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.numbering import number_rows
from starmill.plans.analytics import Star
from starmill.plans.star_load import load_star
from starmill.plans.warehouse import Warehouse
from starmill.session import spread
from starmill.sources.order import file_place
from starmill.workspace import Files, materialize, scratch_path, temporary_tables

NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

MONEY = "decimal(18,2)"

# The test regions stand where a deployment has countries and its own sales regions.
REGIONS = {"EUROPE": "Europe", "AMERICA": "North America", "AFRICA": "North Africa"}
B2B = ["EUROPE", "AMERICA"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    spread(spark, Files(spark).size(path))
    return spark.read.parquet(path)


def padded(key: str, prefix: str, width: int) -> Column:
    """Prefix and zero-padded key; a key longer than the width stays whole."""
    text = F.col(key).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def padded_sql(key: str, prefix: str, width: int) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"concat('{prefix}', lpad({text}, CAST(greatest(length({text}), {width}) AS INTEGER), '0'))"


LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_shipdate",
]


def line_order() -> Column:
    return F.struct(*LINE_ORDER).alias("_ord")


def key_order() -> Column:
    """``LINE_ORDER`` with missing values last, as the SQL sorts."""
    fields = [x for c in LINE_ORDER for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    return F.struct(*fields).alias("_ord")


def sales(spark: SparkSession, sf_dir: str, by_key: bool = False, numbered: bool = False) -> DataFrame:
    """Line items as sales transactions, in the order of their file or, ``by_key``, of ``LINE_ORDER``.

    ``numbered`` lines have their number in that order as a long instead of all it goes by.
    """
    # Columns take their last, short form before they are shuffled.
    buyers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "n_name", "r_name")
    heads = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date")
    ).join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_size", "p_brand", F.col("p_retailprice").cast(MONEY).alias("unit_price")
    )
    discount = F.col("l_discount").cast(MONEY)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        (discount * 100).cast(MONEY).alias("discount"),
        (F.col("l_extendedprice").cast(MONEY) * (1 - discount)).cast(MONEY).alias("total_amount"),
        key_order() if by_key else file_place(),
    )
    if numbered:
        lines = number_rows(lines, ["_ord"], "_at", 0).drop("_ord").withColumnRenamed("_at", "_ord")
    # Parts come last, so that their texts are not shuffled with the lines to the orders; nations
    # and regions, which are few, come after all shuffles.
    rows = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    ).join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        padded("l_orderkey", "ORD", 9).alias("order_id"),
        "order_date",
        padded("c_custkey", "C", 6).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@email.com"))
        .alias("email"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("city"),
        padded("p_partkey", "P", 6).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("size-"), F.col("p_size").cast("string")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        "quantity", "unit_price", "discount", "total_amount", "_ord",
    )


# The place of a line in its file: DuckDB keeps the order of a scan.
SALES = f"""
sales AS (
  SELECT {padded_sql('l_orderkey', 'ORD', 9)} AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         {padded_sql('c_custkey', 'C', 6)} AS customer_id,
         c_name AS customer_name,
         concat(lower(replace(c_name, '#', '.')), '@email.com') AS email,
         r_name AS country, n_name AS city,
         {padded_sql('p_partkey', 'P', 6)} AS product_id,
         p_name AS product_name, p_type AS category,
         concat('size-', CAST(p_size AS VARCHAR)) AS subcategory, p_brand AS brand,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
         CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2)) AS discount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2))
              * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount,
         place AS ord
  FROM (SELECT *, row_number() OVER () AS place FROM lineitem) AS lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

# The same sales sorted as a whole.
SALES_BY_KEY = SALES.replace("place AS ord", f"row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) AS ord").replace(
    "(SELECT *, row_number() OVER () AS place FROM lineitem) AS lineitem", "lineitem"
)

REGION_SQL = (
    "CASE country WHEN 'EUROPE' THEN 'Europe' WHEN 'AMERICA' THEN 'North America' "
    "WHEN 'AFRICA' THEN 'North Africa' ELSE 'Other' END"
)
SEGMENT_SQL = "CASE WHEN country IN ('EUROPE', 'AMERICA') THEN 'B2B' ELSE 'B2C' END"
COST_SQL = (
    "CAST(round_even(CAST(sum(unit_price) AS DOUBLE) / count(unit_price)"
    " * CAST(0.6 AS DOUBLE) * 100, 0) / 100 AS DECIMAL(18,2))"
)

DIMENSIONS = f"""
first_customers AS (
  SELECT * FROM sales
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ord) = 1
),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY ord) AS customer_key, customer_id, customer_name,
         email, country, city, {REGION_SQL} AS region, {SEGMENT_SQL} AS customer_segment,
         first_purchase_date
  FROM first_customers
  JOIN (SELECT customer_id, min(order_date) AS first_purchase_date
        FROM sales GROUP BY customer_id) USING (customer_id)
),
first_products AS (
  SELECT * FROM sales
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ord) = 1
),
dim_product AS (
  SELECT row_number() OVER (ORDER BY ord) AS product_key, product_id, product_name,
         category, subcategory, brand, cost_price, 1 AS is_active
  FROM first_products
  JOIN (SELECT product_id, {COST_SQL} AS cost_price
        FROM sales GROUP BY product_id) USING (product_id)
),
days AS (
  SELECT CAST(unnest(generate_series(
           CAST(make_date(year(low), 1, 1) AS TIMESTAMP),
           CAST(make_date(year(high), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT min(order_date) AS low, max(order_date) AS high FROM sales)
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
         CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         dayname(d) AS day_of_week, CAST(isodow(d) AS INTEGER) AS day_of_week_num,
         monthname(d) AS month_name,
         CAST(CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
         0 AS is_holiday,
         CAST(CASE WHEN month(d) >= 7 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS fiscal_year,
         CAST(CASE WHEN month(d) IN (7, 8, 9) THEN 1 WHEN month(d) IN (10, 11, 12) THEN 2
                   WHEN month(d) IN (1, 2, 3) THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter
  FROM days
),
fact_sales AS (
  SELECT ord AS sale_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
         customer_key, product_key, order_id, CAST(quantity AS BIGINT) AS quantity,
         unit_price, discount, total_amount
  FROM sales
  JOIN (SELECT customer_id, customer_key FROM dim_customer) USING (customer_id)
  JOIN (SELECT product_id, product_key FROM dim_product) USING (product_id)
)"""

STAR = f"WITH {SALES}, {DIMENSIONS}\n"
STAR_BY_KEY = f"WITH {SALES_BY_KEY}, {DIMENSIONS}\n"


_written: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, what: str, make):
    """Build a shared input once per session; queries after the first reuse the files."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _written:
        _written[key] = make()
    return _written[key]


def written_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(
        spark, sf_dir, "sales", lambda: materialize(sales(spark, sf_dir), "sales")
    )


def loaded_warehouse(spark: SparkSession, sf_dir: str, by_key: bool = False) -> Warehouse:
    """A warehouse loaded with all sales, in the order of their file or, ``by_key``, of ``LINE_ORDER``."""
    def load() -> Warehouse:
        warehouse = Warehouse(spark, scratch_path(spark, "warehouse"), MONEY)
        if by_key:
            with temporary_tables(spark):
                load_star(warehouse, materialize(sales(spark, sf_dir, True, numbered=True), "sales"), REGIONS, B2B)
        else:
            load_star(warehouse, written_sales(spark, sf_dir), REGIONS, B2B)
        return warehouse

    return once(spark, sf_dir, "warehouse by key" if by_key else "warehouse", load)


def star(spark: SparkSession, sf_dir: str, by_key: bool = False) -> Star:
    return Star.of(loaded_warehouse(spark, sf_dir, by_key))


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as badly kept text: padding, spellings of nothing, unreadable cells."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    units = F.floor(F.col("o_totalprice") / 1000).cast("int").cast("string")
    bought = F.col("o_orderdate").cast("date").cast("string")
    low = priority == "5-LOW"
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order Key"),
        F.when(status == "F", F.lit("  filled\t")).when(status == "P", " N/A ")
        .otherwise("open").alias(" Order-Status"),
        F.when(priority == "1-URGENT", "-").when(low, " none")
        .otherwise(F.concat(priority, F.lit(chr(0xA0)))).alias("PRIORITY"),
        F.when(status == "P", "null").when(priority == "2-HIGH", "n.a.")
        .otherwise(price).alias("Total  Price"),
        F.when(status != "F", units).alias("units"),
        F.when(low & (status == "F"), "not a date").otherwise(bought).alias("Order Date"),
        F.when(priority == "1-URGENT", "True").when(priority == "2-HIGH", "1")
        .when(low, "False").otherwise("maybe").alias("rush?"),
        F.struct("o_orderkey").alias("_ord"),
    )


# The same rows after names, white space and null tokens are cleaned.
DIRTY = """
orders_clean AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
         CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'P' THEN NULL ELSE 'open' END
           AS order_status,
         CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN NULL ELSE o_orderpriority END
           AS priority,
         CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 'n.a.'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_price,
         CASE WHEN o_orderstatus <> 'F'
              THEN CAST(CAST(floor(o_totalprice / 1000) AS INTEGER) AS VARCHAR) END AS units,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'not a date'
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'True' WHEN '2-HIGH' THEN '1'
              WHEN '5-LOW' THEN 'False' ELSE 'maybe' END AS rush_
  FROM orders
)"""
