"""Queries of the validation rules, over customers and dirty orders."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.clean import before_facts
from starmill.operators.validate import split_valid, tag_violations, validate, violation_table
from starmill.registry.tables import DIRTY, dirty_orders, table

RULES = {
    "order_key": {"required": True, "regex": r"\d{1,4}$"},
    "order_status": {"required": True, "allowed_values": ["open", "shipped"], "min_length": 5},
    "priority": {"regex": r"\w-[A-Z]+", "max_length": 6},
    "total_price": {"min_value": 50000, "max_value": 300000.5},
    "units": {"required": True, "min_value": 10},
    "absent": {"required": True},
    "elsewhere": {"min_value": 1},
}


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return before_facts(dirty_orders(spark, sf_dir), {}).drop("_ord")


def broken(column: str, rule: str, prefix: str, predicate: str, message: str) -> str:
    text = message.replace("'", "''")
    return f"""
SELECT '{column}' AS "column", '{rule}' AS rule, count(*) FILTER (WHERE {predicate}) AS violations,
       CASE WHEN count(*) FILTER (WHERE {predicate}) > 0
            THEN concat('{prefix}', count(*) FILTER (WHERE {predicate}), ' {text}') END AS message
FROM orders_clean"""


PREDICATES = {
    ("order_key", "required"): ("order_key IS NULL", "null value(s)"),
    ("order_key", "regex"): (
        r"NOT regexp_matches(order_key, '^(?:\d{1,4}$)')",
        r"value(s) do not match pattern '\d{1,4}$'",
    ),
    ("order_status", "required"): ("order_status IS NULL", "null value(s)"),
    ("order_status", "allowed_values"): (
        "order_status NOT IN ('open', 'shipped')",
        "value(s) not in allowed set ['open', 'shipped']",
    ),
    ("order_status", "min_length"): (
        "length(order_status) < 5", "value(s) shorter than 5 chars",
    ),
    ("priority", "regex"): (
        r"NOT regexp_matches(priority, '^(?:\w-[A-Z]+)')",
        r"value(s) do not match pattern '\w-[A-Z]+'",
    ),
    ("priority", "max_length"): ("length(priority) > 6", "value(s) longer than 6 chars"),
    ("total_price", "min_value"): (
        "TRY_CAST(total_price AS DOUBLE) < 50000", "value(s) below min (50000)",
    ),
    ("total_price", "max_value"): (
        "TRY_CAST(total_price AS DOUBLE) > 300000.5", "value(s) above max (300000.5)",
    ),
    ("units", "required"): ("units IS NULL", "null value(s)"),
    ("units", "min_value"): ("TRY_CAST(units AS DOUBLE) < 10", "value(s) below min (10)"),
}


def check_sql(*rules: str) -> str:
    parts = [
        broken(column, rule, "Required column has " if rule == "required" else "", *sql)
        for (column, rule), sql in PREDICATES.items() if not rules or rule in rules
    ]
    return f"WITH {DIRTY}" + " UNION ALL ".join(parts)


def one_rule(*names: str):
    """The checks of some rules only."""
    rules = {
        c: {k: v for k, v in r.items() if k in names} for c, r in RULES.items()
    }

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return violation_table(rows_of(spark, sf_dir), rules)

    return query, check_sql(*names)


def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of columns the table lacks, beside the table's row count."""
    rows = rows_of(spark, sf_dir)
    report = validate(rows, {c: RULES[c] for c in ("absent", "elsewhere")})
    pairs = [(c, len(m), m[0] if m else None) for c, m in report["violations"].items()]
    found = spark.createDataFrame(pairs, "column string, messages int, message string")
    return found.select("*", F.lit(rows.count()).cast("long").alias("row_count"))


MISSING_COLUMNS = """
SELECT 'absent' AS "column", 1 AS messages, 'Column ''absent'' is missing from dataset' AS message,
       (SELECT count(*) FROM orders) AS row_count
UNION ALL SELECT 'elsewhere', 0, NULL, (SELECT count(*) FROM orders)"""


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled report, one row per column with messages."""
    found = validate(rows_of(spark, sf_dir), RULES)
    rows = [
        (c, "; ".join(m), len(m), found["total_violations"], found["passed"])
        for c, m in found["violations"].items()
    ]
    return spark.createDataFrame(
        rows, "column string, messages string, n int, total_violations int, passed boolean"
    )


REPORT = f"""
WITH checks AS (SELECT *, row_number() OVER () AS place FROM ({check_sql()})),
found AS (
  SELECT "column", string_agg(message, '; ' ORDER BY
           array_position(['required', 'min_value', 'max_value', 'allowed_values', 'regex',
                           'min_length', 'max_length'], rule)) AS messages,
         CAST(count(*) AS INTEGER) AS n
  FROM checks WHERE violations > 0 GROUP BY "column"
  UNION ALL SELECT 'absent', 'Column ''absent'' is missing from dataset', 1
  UNION ALL SELECT 'elsewhere', '', 0)
SELECT *, CAST((SELECT sum(n) FROM found) AS INTEGER) AS total_violations,
       (SELECT sum(n) FROM found) = 0 AS passed
FROM found"""


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tag_violations(rows_of(spark, sf_dir), RULES)
    return rows.select("order_key", F.concat_ws(",", "_violations").alias("violations"))


_TAGS = ", ".join(
    f"CASE WHEN {predicate} THEN '{column}:{rule}' END"
    for (column, rule), (predicate, _) in PREDICATES.items()
)
TAGS = f"WITH {DIRTY} SELECT order_key, concat_ws(',', {_TAGS}) AS violations FROM orders_clean"

QUARANTINE_RULES = {"acctbal": {"min_value": 0}, "segment": {"allowed_values": ["BUILDING", "MACHINERY"]}}


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")
    )
    good, bad = split_valid(rows, QUARANTINE_RULES)
    return good.select("c_custkey", F.lit("good").alias("side")).unionByName(
        bad.select("c_custkey", F.lit("quarantined").alias("side"))
    )


QUARANTINE = """
SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
                       THEN 'quarantined' ELSE 'good' END AS side
FROM customer"""


QUERIES = {
    "val_1": one_rule("required"),
    "val_2": (missing_columns, MISSING_COLUMNS),
    "val_3": one_rule("min_value"),
    "val_4": one_rule("max_value"),
    "val_5": one_rule("allowed_values"),
    "val_6": one_rule("regex"),
    "val_7": one_rule("min_length"),
    "val_8": one_rule("max_length"),
    "val_9": (report, REPORT),
    "qlt_8": (tags, TAGS),
    "qlt_8_split": (quarantine, QUARANTINE),
}
