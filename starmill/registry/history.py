"""Queries of the history dimension: how the urgency of each customer's orders changed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.history import as_of, changed_versions, daily_states, merge_states, versions
from starmill.registry.tables import table
from starmill.workspace import materialize

KEY = "o_custkey"


def states(orders: DataFrame) -> DataFrame:
    return daily_states(orders, KEY, F.col("o_orderdate"), ["o_orderpriority"], F.col("o_orderkey"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions(states(table(spark, sf_dir, "orders")), KEY)


def _sql(order: str) -> str:
    return f"""
states AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, arg_max(o_orderpriority, {order}) AS o_orderpriority
  FROM orders GROUP BY 1, 2),
changes AS (
  SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY day) IS DISTINCT FROM o_orderpriority
    OR row_number() OVER (PARTITION BY o_custkey ORDER BY day) = 1 AS changed FROM states),
versions AS (
  SELECT o_custkey, row_number() OVER w AS version, o_orderpriority, day AS valid_from, lead(day) OVER w AS valid_to,
         lead(day) OVER w IS NULL AS is_current
  FROM changes WHERE changed WINDOW w AS (PARTITION BY o_custkey ORDER BY day))"""


HISTORY = f"WITH {_sql('o_orderkey')} SELECT * FROM versions"


def late_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches: the second has a third of the orders, of all days, and so changes what is past."""
    orders = table(spark, sf_dir, "orders")
    late = F.col("o_orderkey") % 3 == 0
    stored = materialize(states(orders.where(~late)), "states")
    first = materialize(versions(stored, KEY), "versions")
    batch = materialize(states(orders.where(late)), "states")
    return changed_versions(first, merge_states(stored, batch, KEY), batch, KEY)


LATE = "CASE WHEN o_orderkey % 3 = 0 THEN 1000000000000 ELSE 0 END + o_orderkey"
LATE_HISTORY = f"WITH {_sql(LATE)} SELECT * FROM versions"


def looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the version of its customer from a year before that held on its day."""
    orders = table(spark, sf_dir, "orders")
    earlier = orders.withColumn("o_orderdate", F.add_months("o_orderdate", 12))
    facts = orders.select("o_orderkey", KEY, F.col("o_orderdate").cast("date").alias("bought"))
    return as_of(facts, versions(states(earlier), KEY), KEY, "bought")


LOOKED_UP = f"""
WITH shifted AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS o_orderdate, o_orderpriority, o_orderkey FROM orders),
{_sql('o_orderkey').replace('FROM orders', 'FROM shifted')}
SELECT o_orderkey, o.o_custkey, CAST(o_orderdate AS DATE) AS bought, version, v.o_orderpriority, valid_from, valid_to, is_current
FROM orders o LEFT JOIN versions v ON v.o_custkey = o.o_custkey AND CAST(o_orderdate AS DATE) >= valid_from
  AND (valid_to IS NULL OR CAST(o_orderdate AS DATE) < valid_to)"""

QUERIES = {
    "scd_2": (history, HISTORY),
    "scd_2_late": (late_history, LATE_HISTORY),
    "scd_2_lookup": (looked_up, LOOKED_UP),
}
