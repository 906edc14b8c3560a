"""Queries of the engine's own joins: key lookup, reload, upsert, new days."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.calendar import date_key
from starmill.operators.dedup import deduplicate
from starmill.plans.star_load import new_dates, stored_orders
from starmill.plans.warehouse import FACT
from starmill.registry.loads import BATCHES, MAPPED, partly_mapped, upserted
from starmill.registry.tables import SALES, loaded_warehouse, table, written_sales


def fates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left joins of the load: what becomes of each line, and why some are dropped."""
    fate = F.coalesce("_dropped", F.lit("loaded")).alias("fate")
    return partly_mapped(spark, sf_dir).groupBy(fate).agg(F.count("*").alias("lines"))


FATES = f"""WITH {MAPPED}
SELECT CASE WHEN customer_key IS NULL THEN 'customer' WHEN product_key IS NULL THEN 'product'
            WHEN date_key IS NULL THEN 'date' ELSE 'loaded' END AS fate, count(*) AS lines
FROM mapped GROUP BY 1"""


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys looked up for every line that can be loaded."""
    return partly_mapped(spark, sf_dir).where("_dropped IS NULL").groupBy(
        "customer_key", "product_key"
    ).agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))


KEYED = f"""WITH {MAPPED}
SELECT customer_key, product_key, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity
FROM mapped
WHERE customer_key IS NOT NULL AND product_key IS NOT NULL AND date_key IS NOT NULL
GROUP BY 1, 2"""


def urgent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of urgent sales, as a batch that is loaded again."""
    return written_sales(spark, sf_dir).where("quantity = 50 AND order_date < '1996-01-01'")


def kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti join of a reload: stored lines as read once the orders of a batch are deleted, with their products."""
    warehouse = loaded_warehouse(spark, sf_dir)
    base = warehouse.current()
    gone = warehouse.write_deleted(urgent(spark, sf_dir).select("order_id").distinct(), base.version + 1)
    live = warehouse.live_facts(base.tables[FACT], [gone])
    products = warehouse.table("dim_product", base).select("product_key", "product_id")
    return live.join(products, "product_key").select(
        "order_id", "product_id", F.col("quantity").cast("int"), "total_amount"
    )


_URGENT = "SELECT order_id FROM sales WHERE quantity = 50 AND order_date < DATE '1996-01-01'"
KEPT_LINES = f"""WITH {SALES}
SELECT order_id, product_id, quantity, total_amount FROM sales WHERE order_id NOT IN ({_URGENT})"""


def replaced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semi join of a reload: the batch's orders that are stored, and their lines."""
    warehouse = loaded_warehouse(spark, sf_dir)
    return stored_orders(warehouse, warehouse.current(), urgent(spark, sf_dir))


REPLACED_LINES = f"""WITH {SALES}
SELECT order_id, count(*) AS lines FROM sales WHERE order_id IN ({_URGENT}) GROUP BY 1"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full join of an upsert: customers kept, updated and new."""
    return upserted(spark, sf_dir).groupBy("_change").agg(F.count("*").alias("customers"))


CHANGES = f"WITH {BATCHES} SELECT _change, count(*) AS customers FROM customers GROUP BY 1"


def unseen_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct and except: days of any order that no finished order has."""
    orders = table(spark, sf_dir, "orders").select(
        date_key(F.col("o_orderdate").cast("date")).alias("date_key"), "o_orderstatus",
        F.struct("o_orderkey").alias("_ord"),
    )
    finished = orders.where("o_orderstatus = 'F'").select("date_key")
    return new_dates(finished, deduplicate(orders, ["date_key"])).select("date_key")


UNSEEN_DAYS = """
SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders
WHERE strftime(o_orderdate, '%Y%m%d') NOT IN (
  SELECT strftime(o_orderdate, '%Y%m%d') FROM orders WHERE o_orderstatus = 'F')"""

QUERIES = {
    "jon_2": (fates, FATES),
    "jon_3": (keyed, KEYED),
    "jon_4": (kept_lines, KEPT_LINES),
    "jon_5": (replaced_lines, REPLACED_LINES),
    "jon_6": (changes, CHANGES),
    "set_2": (unseen_days, UNSEEN_DAYS),
}
