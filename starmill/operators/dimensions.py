"""Dimensions built from transactions."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.calendar import calendar_columns
from starmill.functions.customers import region_of, segment_of
from starmill.functions.fixed import B2B_COUNTRIES, COST_SHARE, REGIONS
from starmill.functions.text import day
from starmill.operators.numbering import is_numeric_place

CUSTOMER_COLUMNS = ["customer_name", "email", "country", "city"]
PRODUCT_COLUMNS = ["product_name", "category", "subcategory", "brand"]


def first_rows(
    df: DataFrame, key: str, columns: list[str],
    extra: dict[str, tuple[Column, Callable[[str], Column]]] | None = None,
) -> DataFrame:
    """Per key, the given columns of its first row, its place, and extra aggregates.

    ``extra`` names aggregates, each with the aggregate that merges parts of it.
    Each input task keeps one row per key before the shuffle, whatever share of
    the table the key holds. The place leads the columns in one struct, so that
    it is shuffled once. Only what is compared by hash needs no sort of all rows:
    where the place is a long, rows that agree in all columns become one by hash first.
    """
    extra = extra or {}
    first = F.min(F.struct("_ord", *columns)).alias("first")
    whole = [c.alias(n) for n, (c, _) in extra.items()]
    if is_numeric_place(df):
        df = df.groupBy(key, *columns).agg(F.min("_ord").alias("_ord"), *whole)
        whole = [merged(n).alias(n) for n, (_, merged) in extra.items()]
    return df.groupBy(key).agg(first, *whole).select(
        key, *[f"first.{c}" for c in columns], *extra, "first._ord"
    )


def customer_dimension(
    sales: DataFrame, regions: dict[str, str] = REGIONS, b2b: list[str] = B2B_COUNTRIES
) -> DataFrame:
    """One row per customer: first seen attributes, region, segment, first purchase."""
    extra = {}
    if "order_date" in sales.columns:
        bought = day(F.col("order_date"), sales.schema["order_date"].dataType)
        extra["first_purchase_date"] = (F.min(bought), F.min)
    return first_rows(sales, "customer_id", CUSTOMER_COLUMNS, extra).select(
        "customer_id",
        *CUSTOMER_COLUMNS,
        region_of(F.col("country"), regions).alias("region"),
        segment_of(F.col("country"), b2b).alias("customer_segment"),
        *extra,
        "_ord",
    )


def cost_price(total: Column, count: Column, dtype: T.DataType) -> Column:
    """The fixed share of the mean price, to the cent."""
    mean = F.try_divide(total.cast("double"), count)
    cost = F.rint(mean * COST_SHARE * 100) / 100
    return cost.cast("decimal(18,2)") if isinstance(dtype, T.DecimalType) else cost


def product_dimension(sales: DataFrame) -> DataFrame:
    """One row per product: first seen attributes, cost price, active flag."""
    extra, cost = {}, []
    if "unit_price" in sales.columns:
        extra = {"_total": (F.sum("unit_price"), F.sum), "_count": (F.count("unit_price"), F.sum)}
        cost = [cost_price(F.col("_total"), F.col("_count"), sales.schema["unit_price"].dataType).alias("cost_price")]
    return first_rows(sales, "product_id", PRODUCT_COLUMNS, extra).select(
        "product_id", *PRODUCT_COLUMNS, *cost, F.lit(1).alias("is_active"), "_ord"
    )


def _calendar(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("full_date"))
    return days.select(
        *[c.alias(n) for n, c in calendar_columns(F.col("full_date")).items()]
    )


def date_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end with its calendar attributes."""
    one = spark.range(1)
    return _calendar(one.select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    ))


def date_dimension_for(sales: DataFrame, column: str = "order_date") -> DataFrame:
    """The whole years that hold the dates of a column."""
    when = day(F.col(column), sales.schema[column].dataType)
    ends = sales.agg(F.min(when).alias("low"), F.max(when).alias("high")).where(
        "low IS NOT NULL"
    )
    return _calendar(ends.select(
        F.make_date(F.year("low"), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.year("high"), F.lit(12), F.lit(31)).alias("end"),
    ))
