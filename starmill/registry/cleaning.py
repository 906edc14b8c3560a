"""Queries of the cleaning steps, over orders kept as dirty text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators import clean as c
from starmill.operators.profile import page, page_after
from starmill.registry.tables import DIRTY, dirty_orders, table


def shown(df: DataFrame) -> DataFrame:
    return df.drop("_ord")


def standard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.standardize_names(dirty_orders(spark, sf_dir)))


STANDARD_NAMES = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
       CASE o_orderstatus WHEN 'F' THEN concat('  filled', chr(9)) WHEN 'P' THEN ' N/A '
            ELSE 'open' END AS order_status,
       CASE o_orderpriority WHEN '1-URGENT' THEN '-' WHEN '5-LOW' THEN ' none'
            ELSE concat(o_orderpriority, chr(160)) END AS priority,
       CASE WHEN o_orderstatus = 'P' THEN 'null' WHEN o_orderpriority = '2-HIGH' THEN 'n.a.'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_price,
       CASE WHEN o_orderstatus <> 'F'
            THEN CAST(CAST(floor(o_totalprice / 1000) AS INTEGER) AS VARCHAR) END AS units,
       CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'not a date'
            ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'True' WHEN '2-HIGH' THEN '1'
            WHEN '5-LOW' THEN 'False' ELSE 'maybe' END AS rush_
FROM orders"""


def stripped_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, padded with white space of several kinds and stripped again."""
    docs = table(spark, sf_dir, "documents")
    padded = docs.select(
        "doc_id",
        F.concat(F.lit("\t\xa0 "), "text", F.lit(" \n")).alias("text"),
        F.concat(F.lit(" "), "lang").alias("lang"),
    )
    return c.strip_strings(padded)


_SPACES = " || ".join(f"chr({ord(x)})" for x in c.text.WHITESPACE)
STRIPPED_TEXT = f"""
SELECT doc_id, trim(text, {_SPACES}) AS text, trim(lang, {_SPACES}) AS lang FROM documents"""


def tokens_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.before_facts(dirty_orders(spark, sf_dir), {}))


TOKENS_NULL = f"WITH {DIRTY} SELECT * FROM orders_clean"


def rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.before_facts(dirty_orders(spark, sf_dir), {"null_strategy": "drop_rows"}))


ROWS_DROPPED = f"""
WITH {DIRTY} SELECT * FROM orders_clean
WHERE order_status IS NOT NULL AND priority IS NOT NULL AND total_price IS NOT NULL
  AND units IS NOT NULL AND order_date IS NOT NULL AND rush_ IS NOT NULL"""


def given_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"order_status": "unset", "units": 7, "nowhere": "x"}
    return shown(c.fill_given(c.before_facts(dirty_orders(spark, sf_dir), {}), values))


GIVEN_FILLS = f"""
WITH {DIRTY}
SELECT order_key, coalesce(order_status, 'unset') AS order_status, priority, total_price,
       coalesce(units, '7') AS units, order_date, rush_
FROM orders_clean"""


def filled(spark: SparkSession, sf_dir: str, column: str, hint: str) -> DataFrame:
    config = {"null_strategy": "fill", "type_map": {column: hint}}
    rows = c.before_facts(dirty_orders(spark, sf_dir), config).select("order_key", column, "_ord")
    return shown(c.fill_missing(rows, config, c.column_facts(rows, config)))


def median_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled(spark, sf_dir, "units", "int")


MEDIAN_FILL = f"""
WITH {DIRTY},
middle AS (SELECT CAST(CAST(round_even(quantile_cont(CAST(units AS DOUBLE), 0.5), 0) AS BIGINT)
                       AS VARCHAR) AS fill FROM orders_clean)
SELECT order_key, coalesce(units, fill) AS units FROM orders_clean, middle"""


def mean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled prices, rounded to cents: the last digits of a mean depend on summation order."""
    rows = filled(spark, sf_dir, "total_price", "float")
    number = F.col("total_price").try_cast("double").cast("decimal(18,2)")
    return rows.select("order_key", number.alias("total_price"))


MEAN_FILL = f"""
WITH {DIRTY},
middle AS (SELECT avg(TRY_CAST(total_price AS DOUBLE)) AS fill FROM orders_clean)
SELECT order_key,
       CAST(CASE WHEN total_price IS NULL THEN fill ELSE TRY_CAST(total_price AS DOUBLE) END
            AS DECIMAL(18,2)) AS total_price
FROM orders_clean, middle"""


def word_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = {"null_strategy": "fill", "type_map": {"order_date": "datetime"}}
    rows = c.before_facts(dirty_orders(spark, sf_dir), config)
    rows = rows.select("order_key", "order_status", "priority", "order_date", "_ord").withColumn(
        "order_date", F.when(F.col("order_status").isNotNull(), F.col("order_date"))
    )
    return shown(c.fill_missing(rows, config, c.ColumnFacts()))


WORD_FILL = f"""
WITH {DIRTY}
SELECT order_key, coalesce(order_status, 'Unknown') AS order_status,
       coalesce(priority, 'Unknown') AS priority,
       CASE WHEN order_status IS NOT NULL THEN order_date END AS order_date
FROM orders_clean"""


def nulls_reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.null_counts(c.before_facts(dirty_orders(spark, sf_dir), {"null_strategy": "report"}))


NULLS_REPORTED = f"""
WITH {DIRTY}
SELECT count(*) - count(order_key) AS order_key, count(*) - count(order_status) AS order_status,
       count(*) - count(priority) AS priority, count(*) - count(total_price) AS total_price,
       count(*) - count(units) AS units, count(*) - count(order_date) AS order_date,
       count(*) - count(rush_) AS rush_
FROM orders_clean"""


def casts(spark: SparkSession, sf_dir: str, **types: str) -> DataFrame:
    config = {"type_map": types}
    rows = c.before_facts(dirty_orders(spark, sf_dir), config).select("order_key", *types, "_ord")
    return shown(c.cast_types(rows, config, c.column_facts(rows, config)))


def int_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``units`` are whole and become long; ``total_price`` has fractions and stays text."""
    return casts(spark, sf_dir, units="int", total_price="int")


INT_CAST = f"""
WITH {DIRTY} SELECT order_key, CAST(units AS BIGINT) AS units, total_price FROM orders_clean"""


def float_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return casts(spark, sf_dir, units="float", total_price="float")


FLOAT_CAST = f"""
WITH {DIRTY}
SELECT order_key, CAST(units AS DOUBLE) AS units, TRY_CAST(total_price AS DOUBLE) AS total_price
FROM orders_clean"""


def date_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return casts(spark, sf_dir, order_date="datetime")


DATE_CAST = f"""
WITH {DIRTY}
SELECT order_key, CAST(TRY_CAST(order_date AS DATE) AS TIMESTAMP) AS order_date FROM orders_clean"""


def bool_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return casts(spark, sf_dir, rush_="bool")


BOOL_CAST = f"""
WITH {DIRTY}
SELECT order_key, CASE WHEN rush_ IN ('True', '1') THEN true
                       WHEN rush_ IN ('False', '0') THEN false END AS rush_
FROM orders_clean"""


def empty_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = c.before_facts(dirty_orders(spark, sf_dir), {})
    rows = rows.select("order_status", "priority", "total_price", "_ord").withColumn("_lineage", F.lit("x"))
    return shown(c.drop_empty_rows(rows))


EMPTY_DROPPED = f"""
WITH {DIRTY}
SELECT order_status, priority, total_price, 'x' AS _lineage FROM orders_clean
WHERE order_status IS NOT NULL OR priority IS NOT NULL OR total_price IS NOT NULL"""


CLEAN_CONFIG = {
    "null_strategy": "fill",
    "type_map": {"units": "int", "order_date": "datetime", "rush_": "bool"},
}


def all_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.clean(dirty_orders(spark, sf_dir), CLEAN_CONFIG))


ALL_STEPS = f"""
WITH {DIRTY},
middle AS (SELECT CAST(round_even(quantile_cont(CAST(units AS DOUBLE), 0.5), 0) AS BIGINT) AS fill
           FROM orders_clean)
SELECT order_key, coalesce(order_status, 'Unknown') AS order_status,
       coalesce(priority, 'Unknown') AS priority, coalesce(total_price, 'Unknown') AS total_price,
       coalesce(CAST(units AS BIGINT), fill) AS units,
       CAST(TRY_CAST(order_date AS DATE) AS TIMESTAMP) AS order_date,
       CASE WHEN rush_ IN ('True', '1') THEN true
            WHEN rush_ IN ('False', '0') THEN false END AS rush_
FROM orders_clean, middle"""


def metadata_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value",
        F.get_json_object("props", "$.k").alias("k"),
        F.lit("events").alias("_source_file"),
    )
    return c.drop_metadata(events)


METADATA_DROPPED = """
SELECT event_id, event_type, value, json_extract_string(props, '$.k') AS k FROM events"""


def third_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the orders, largest first, with the number of all rows."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("rank"))
    picked = page(rows, ["rank", "o_orderkey"], number=3, size=20).drop("rank")
    return picked.select("*", F.lit(orders.count()).cast("long").alias("total"))


THIRD_PAGE = """
SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40"""


def next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return page_after(orders, "o_orderkey", 1000, size=20)


NEXT_PAGE = """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 20"""


def number_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and numbers as null tokens, None among them, on columns of several types."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    first = parts.agg(F.min("p_brand")).first()[0]
    return c.null_tokens(parts, [first, None, 7, -1])


NUMBER_TOKENS = """
SELECT nullif(p_partkey, 7) AS p_partkey,
       CASE WHEN p_brand <> (SELECT min(p_brand) FROM part) THEN p_brand END AS p_brand,
       nullif(p_size, 7) AS p_size, nullif(p_retailprice, 7) AS p_retailprice FROM part"""


def with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account balances, where a debt is not a number and a small one unknown."""
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(balance < 0, F.lit(float("nan"))).when(balance > 100, balance).alias("balance"),
    )


def nan_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is not a number is filled like a null, by the mean of the numbers."""
    rows = with_nan(spark, sf_dir)
    config = {"null_strategy": "fill"}
    filled_rows = c.fill_missing(rows, config, c.column_facts(rows, config))
    return filled_rows.select("c_custkey", F.col("balance").cast("decimal(18,2)").alias("balance"))


NAN_FILLED = """
SELECT c_custkey, CAST(CASE WHEN c_acctbal > 100 THEN c_acctbal
  ELSE (SELECT avg(c_acctbal) FROM customer WHERE c_acctbal > 100) END AS DECIMAL(18,2)) AS balance
FROM customer"""


def nan_reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.null_counts(with_nan(spark, sf_dir))


NAN_REPORTED = """
SELECT 0::BIGINT AS c_custkey, count(*) FILTER (WHERE NOT c_acctbal > 100) AS balance FROM customer"""

QUERIES = {
    "cln_3_numbers": (number_tokens, NUMBER_TOKENS),
    "cln_7_nan": (nan_filled, NAN_FILLED),
    "cln_9_nan": (nan_reported, NAN_REPORTED),
    "cln_1": (standard_names, STANDARD_NAMES),
    "cln_2": (stripped_text, STRIPPED_TEXT),
    "cln_3": (tokens_null, TOKENS_NULL),
    "cln_4": (rows_dropped, ROWS_DROPPED),
    "cln_5": (given_fills, GIVEN_FILLS),
    "cln_6": (median_fill, MEDIAN_FILL),
    "cln_7": (mean_fill, MEAN_FILL),
    "cln_8": (word_fill, WORD_FILL),
    "cln_9": (nulls_reported, NULLS_REPORTED),
    "cln_10": (int_cast, INT_CAST),
    "cln_11": (float_cast, FLOAT_CAST),
    "cln_12": (date_cast, DATE_CAST),
    "cln_13": (bool_cast, BOOL_CAST),
    "cln_14": (empty_dropped, EMPTY_DROPPED),
    "cln_15": (all_steps, ALL_STEPS),
    "cln_16": (metadata_dropped, METADATA_DROPPED),
    "cln_17": (third_page, THIRD_PAGE),
    "cln_17_after": (next_page, NEXT_PAGE),
    "srt_3": (third_page, THIRD_PAGE),
}
