"""Queries of the star join, the joins by kind and the analytics."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.numbering import exact_medians
from starmill.plans import analytics as a
from starmill.registry.tables import MONEY, SALES, STAR, STAR_BY_KEY, star, table
from starmill.sources.extract import union_by_name

SUM = "decimal(28,2)"


def exact_sums(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(SUM) for c in columns})


def star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star as one table; sales are numbered in one order of all lines."""
    rows = a.sales_analysis(star(spark, sf_dir, by_key=True))
    return rows.withColumn("profit", F.col("profit").cast(MONEY))


STAR_VIEW = STAR_BY_KEY + """
SELECT sale_id, order_id, full_date, year, quarter, month, month_name, day_of_week,
       customer_id, customer_name, email, country, city, customer_segment,
       product_id, product_name, category, subcategory, brand,
       quantity, unit_price, discount, total_amount,
       CAST(total_amount - coalesce(cost_price, 0) * quantity AS DECIMAL(18,2)) AS profit,
       CAST(discount AS DOUBLE) / 100.0 * CAST(unit_price AS DOUBLE) * quantity AS discount_amount
FROM fact_sales
JOIN dim_date USING (date_key)
JOIN dim_customer USING (customer_key)
JOIN dim_product USING (product_key)"""


def left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate joined back to a dimension; customers without orders stay."""
    spent = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order"),
        F.sum(F.col("o_totalprice").cast(MONEY)).cast(SUM).alias("spent"),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(
        spent, "c_custkey", "left"
    )


LEFT_JOIN = """
SELECT c_custkey, c_name, first_order, spent
FROM customer LEFT JOIN (
  SELECT o_custkey AS c_custkey, min(o_orderdate) AS first_order,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS spent
  FROM orders GROUP BY 1) USING (c_custkey)"""


def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key map looked up for every line item."""
    keys = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return table(spark, sf_dir, "lineitem").join(keys, "l_partkey").groupBy("p_brand").agg(
        F.count("*").alias("lines")
    )


LOOKUP_JOIN = """
SELECT p_brand, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""


def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent open order."""
    urgent = "o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'"
    buyers = table(spark, sf_dir, "orders").where(urgent).select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(buyers, "c_custkey", "left_anti")


ANTI_JOIN = """
SELECT * FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')"""


def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of the orders in a key list."""
    listed = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    return table(spark, sf_dir, "lineitem").join(listed, "l_orderkey", "left_semi")


SEMI_JOIN = """
SELECT * FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""


def full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new customer records side by side, new values winning."""
    customers = table(spark, sf_dir, "customer")
    old = customers.where("c_acctbal < 5000").select("c_custkey", F.col("c_name").alias("old_name"))
    new = customers.where("c_acctbal >= 0").select(
        "c_custkey", F.upper("c_name").alias("new_name")
    )
    return old.join(new, "c_custkey", "full_outer").select(
        "c_custkey",
        F.coalesce("new_name", "old_name").alias("name"),
        F.when(F.col("old_name").isNull(), "insert").when(F.col("new_name").isNull(), "keep")
        .otherwise("update").alias("change"),
    )


FULL_JOIN = """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN upper(c_name) ELSE c_name END AS name,
       CASE WHEN c_acctbal >= 5000 THEN 'insert' WHEN c_acctbal < 0 THEN 'keep' ELSE 'update' END
         AS change
FROM customer"""


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sums(a.monthly_revenue(star(spark, sf_dir)), "revenue")


MONTHLY = STAR + """
SELECT year, quarter, month, month_name, count(*) AS transactions,
       CAST(sum(total_amount) AS DECIMAL(28,2)) AS revenue
FROM fact_sales JOIN dim_date USING (date_key)
GROUP BY year, quarter, month, month_name ORDER BY year, month"""


def subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sums(a.revenue_subtotals(star(spark, sf_dir)), "revenue")


SUBTOTALS = STAR + """
SELECT year, quarter, month,
       CASE WHEN grouping(year) = 1 THEN 'total' WHEN grouping(quarter) = 1 THEN 'year'
            WHEN grouping(month) = 1 THEN 'quarter' ELSE 'month' END AS level,
       count(*) AS transactions, CAST(sum(total_amount) AS DECIMAL(28,2)) AS revenue,
       CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_transaction
FROM fact_sales JOIN dim_date USING (date_key)
GROUP BY ROLLUP (year, quarter, month)"""


def leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sums(a.top_customers(star(spark, sf_dir)), "total_revenue")


LEADERS = STAR + """
SELECT customer_key, customer_id, customer_name, country, customer_segment,
       CAST(sum(total_amount) AS DECIMAL(28,2)) AS total_revenue, count(*) AS order_count
FROM fact_sales JOIN dim_customer USING (customer_key)
GROUP BY ALL ORDER BY total_revenue DESC, customer_key LIMIT 10"""


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sums(a.category_performance(star(spark, sf_dir)), "revenue", "profit")


CATEGORIES = STAR + """
SELECT category, count(*) AS transactions, CAST(sum(quantity) AS BIGINT) AS units_sold,
       CAST(sum(total_amount) AS DECIMAL(28,2)) AS revenue,
       CAST(sum(total_amount - quantity * cost_price) AS DECIMAL(28,2)) AS profit,
       CAST(CAST(sum(total_amount) AS DECIMAL(28,2)) AS DOUBLE) / count(*) AS avg_order_value
FROM fact_sales JOIN dim_product USING (product_key) GROUP BY category"""


def weekends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sums(a.weekend_sales(star(spark, sf_dir)), "revenue")


WEEKENDS = STAR + """
SELECT CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       count(*) AS transactions, CAST(sum(total_amount) AS DECIMAL(28,2)) AS revenue,
       CAST(CAST(sum(total_amount) AS DECIMAL(28,2)) AS DOUBLE) / count(*) AS avg_transaction
FROM fact_sales JOIN dim_date USING (date_key) GROUP BY 1"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sums(a.segment_revenue(star(spark, sf_dir)), "revenue")


SEGMENTS = STAR + """
SELECT customer_segment, count(DISTINCT customer_key) AS customers,
       CAST(sum(total_amount) AS DECIMAL(28,2)) AS revenue
FROM fact_sales JOIN dim_customer USING (customer_key) GROUP BY customer_segment"""


def profits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sums(a.category_profit(star(spark, sf_dir)), "revenue", "cost", "profit")


PROFITS = STAR + """
SELECT category, CAST(sum(total_amount) AS DECIMAL(28,2)) AS revenue,
       CAST(sum(quantity * cost_price) AS DECIMAL(28,2)) AS cost,
       CAST(sum(total_amount - quantity * cost_price) AS DECIMAL(28,2)) AS profit
FROM fact_sales JOIN dim_product USING (product_key) GROUP BY category"""


def scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast(MONEY)
    return table(spark, sf_dir, "orders").agg(
        F.count("*").alias("n"),
        F.count_distinct("o_custkey").alias("buyers"),
        F.sum(price).cast(SUM).alias("total"),
        (F.sum(price).cast(SUM).cast("double") / F.count("*")).alias("mean"),
        F.min("o_orderdate").alias("first"),
        F.max("o_orderdate").alias("last"),
        F.count_if(F.nullif("o_orderstatus", F.lit("F")).isNull()).alias("nulls"),
    )


SCALARS = """
SELECT count(*) AS n, count(DISTINCT o_custkey) AS buyers,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total,
       CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS DOUBLE) / count(*)
         AS mean,
       min(o_orderdate) AS first, max(o_orderdate) AS last,
       count(*) - count(nullif(o_orderstatus, 'F')) AS nulls
FROM orders"""


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.max("value").alias("top")
    ).orderBy(F.desc("n"), "event_type")


VALUE_COUNTS = """
SELECT event_type, count(*) AS n, max(value) AS top FROM events
GROUP BY event_type ORDER BY n DESC, event_type"""


def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of two columns."""
    lines = table(spark, sf_dir, "lineitem")
    found = exact_medians(lines, {
        "quantity": F.col("l_quantity"), "price": F.col("l_extendedprice"),
    })
    return spark.createDataFrame(sorted(found.items()), "name string, median double")


MEDIANS = """
SELECT 'quantity' AS name, quantile_cont(l_quantity, 0.5) AS median FROM lineitem
UNION ALL SELECT 'price', quantile_cont(l_extendedprice, 0.5) FROM lineitem"""


def united(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables by column name; missing columns are null, a disputed type becomes text."""
    return union_by_name([
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
        ),
        table(spark, sf_dir, "part").select(
            F.col("p_partkey").cast("string").alias("id"), F.col("p_size").alias("size")
        ),
        table(spark, sf_dir, "supplier").select(
            F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
        ),
    ])


UNITED = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(NULL AS INTEGER) AS size FROM customer
UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, p_size FROM part
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier"""


QUERIES = {
    "jon_1": (star_view, STAR_VIEW),
    "jon_2_plain": (left_join, LEFT_JOIN),
    "jon_3_plain": (lookup_join, LOOKUP_JOIN),
    "jon_4_plain": (anti_join, ANTI_JOIN),
    "jon_5_plain": (semi_join, SEMI_JOIN),
    "jon_6_plain": (full_join, FULL_JOIN),
    "agg_1": (monthly, MONTHLY),
    "agg_1_subtotals": (subtotals, SUBTOTALS),
    "agg_2": (leaders, LEADERS),
    "agg_3": (categories, CATEGORIES),
    "agg_4": (weekends, WEEKENDS),
    "agg_5": (segments, SEGMENTS),
    "agg_6": (profits, PROFITS),
    "agg_7": (scalars, SCALARS),
    "agg_7_counts": (value_counts, VALUE_COUNTS),
    "agg_7_median": (medians, MEDIANS),
    "srt_1": (monthly, MONTHLY),
    "srt_2": (leaders, LEADERS),
    "set_1": (united, UNITED),
}
