"""Queries of duplicate removal: line items repeat their order and line number."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.dedup import add_row_hash, deduplicate, duplicate_report
from starmill.registry.tables import LINE_ORDER, line_order, table

KEYS = ["l_orderkey", "l_linenumber"]
ORDER = ", ".join(LINE_ORDER)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("_ord", line_order())


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal in every data column; the first row's lineage is kept."""
    rows = lines(spark, sf_dir).select(
        *KEYS, "l_returnflag", F.col("l_partkey").alias("_part"), "_ord"
    )
    return deduplicate(rows).drop("_ord")


EXACT = f"""
SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey AS _part FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag ORDER BY {ORDER}) = 1"""


def nulls_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null keys form one group; most rows share it."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).alias("buyer"),
        "o_orderstatus", "o_orderkey", F.struct("o_orderkey").alias("_ord"),
    )
    return deduplicate(orders, ["buyer", "o_orderstatus"]).drop("_ord")


NULLS_EQUAL = """
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS buyer, o_orderstatus, o_orderkey
FROM orders
QUALIFY row_number() OVER (
  PARTITION BY CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END, o_orderstatus
  ORDER BY o_orderkey) = 1"""


def keeping(which: str | bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return deduplicate(lines(spark, sf_dir), KEYS, which).drop("_ord")

    return query


def keep_sql(condition: str) -> str:
    return f"SELECT * FROM lineitem QUALIFY {condition}"


_LAST = ", ".join(f"{c} DESC" for c in LINE_ORDER)
_KEYS = ", ".join(KEYS)


def partly_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the key columns does not exist; the other decides."""
    return deduplicate(lines(spark, sf_dir), ["l_orderkey", "no_such_column"]).drop("_ord")


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints over text, long, double, timestamp and null cells."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("buyer"),
        F.lit("ignored").alias("_lineage"),
    )
    return add_row_hash(rows).select("o_orderkey", "_row_hash")


HASHED = """
SELECT o_orderkey, sha256(concat_ws('|',
         CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(o_totalprice AS VARCHAR),
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
         coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END, 'nan'),
         coalesce(CAST(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS VARCHAR), '<NA>')
       )) AS _row_hash
FROM orders"""


def reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = duplicate_report(lines(spark, sf_dir), KEYS)
    return spark.createDataFrame(
        [tuple(report.values())],
        "total_rows long, duplicate_rows long, unique_rows long, duplicate_percent double",
    )


REPORTED = f"""
WITH groups AS (SELECT count(*) AS n FROM lineitem GROUP BY {_KEYS}),
totals AS (SELECT CAST(sum(n) AS BIGINT) AS total_rows,
                  CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows
           FROM groups)
SELECT total_rows, duplicate_rows, total_rows - duplicate_rows AS unique_rows,
       CAST(printf('%.2f', duplicate_rows / total_rows * 100) AS DOUBLE) AS duplicate_percent
FROM totals"""


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys of one table that another lacks."""
    bought = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key")).distinct()
    cheap = table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("key"))
    return bought.join(cheap, "key", "left_anti")


DISTINCT_KEYS = """
SELECT DISTINCT l_partkey AS key FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)"""


QUERIES = {
    "dup_1": (exact, EXACT),
    "dup_1_nulls": (nulls_equal, NULLS_EQUAL),
    "dup_2": (
        keeping("first"),
        keep_sql(f"row_number() OVER (PARTITION BY {_KEYS} ORDER BY {ORDER}) = 1"),
    ),
    "dup_3": (
        keeping("last"),
        keep_sql(f"row_number() OVER (PARTITION BY {_KEYS} ORDER BY {_LAST}) = 1"),
    ),
    "dup_4": (keeping(False), keep_sql(f"count(*) OVER (PARTITION BY {_KEYS}) = 1")),
    "dup_5": (
        partly_missing,
        keep_sql(f"row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDER}) = 1"),
    ),
    "dup_6": (hashed, HASHED),
    "dup_7": (reported, REPORTED),
    "set_2_plain": (distinct_keys, DISTINCT_KEYS),
}
