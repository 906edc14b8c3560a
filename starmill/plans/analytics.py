"""Sales analytics over the star.

Reports count the fact by its foreign key first and join the small result to
the dimension, so the fact itself is never shuffled for a join and a hot key is
one row per task. Every report is exact: its measures are sums and counts.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.plans.warehouse import FACT, Warehouse


@dataclass
class Star:
    fact: DataFrame
    dates: DataFrame
    customers: DataFrame
    products: DataFrame

    @classmethod
    def of(cls, warehouse: Warehouse) -> "Star":
        at = warehouse.current()
        return cls(
            warehouse.table(FACT, at),
            warehouse.table("dim_date", at),
            warehouse.table("dim_customer", at),
            warehouse.table("dim_product", at),
        )


def sales_analysis(star: Star) -> DataFrame:
    """One row per sale with its date, customer and product, profit and discount amount.

    The optimizer broadcasts each dimension whose stored size allows it; the
    others meet the fact in a sorted join that splits skewed keys. Days, which are
    few, come last, so that what they add is not shuffled for the others.
    """
    f, d, c, p = star.fact, star.dates, star.customers, star.products
    return (
        f.join(c, "customer_key")
        .join(p, "product_key")
        .join(d, "date_key")
        .select(
            "sale_id", "order_id",
            "full_date", "year", "quarter", "month", "month_name", "day_of_week",
            "customer_id", "customer_name", "email", "country", "city", "customer_segment",
            "product_id", "product_name", "category", "subcategory", "brand",
            "quantity", "unit_price", "discount", "total_amount",
            (F.col("total_amount") - F.coalesce("cost_price", F.lit(0)) * F.col("quantity"))
            .alias("profit"),
            (
                F.col("discount").cast("double") / 100.0
                * F.col("unit_price").cast("double") * F.col("quantity")
            ).alias("discount_amount"),
        )
    )


def _by_key(fact: DataFrame, key: str) -> DataFrame:
    """Additive measures per foreign key; everything a report needs adds up from these."""
    return fact.groupBy(key).agg(
        F.count("*").alias("n"),
        F.sum("quantity").alias("units"),
        F.sum("total_amount").alias("amount"),
    )


def _mean(amount: Column, n: Column) -> Column:
    return amount.cast("double") / n


def monthly_revenue(star: Star) -> DataFrame:
    days = _by_key(star.fact, "date_key")
    return (
        days.join(star.dates, "date_key")
        .groupBy("year", "quarter", "month", "month_name")
        .agg(F.sum("n").alias("transactions"), F.sum("amount").alias("revenue"))
        .orderBy("year", "month")
    )


def revenue_subtotals(star: Star) -> DataFrame:
    """Transactions and revenue by month, quarter and year and in total; ``level`` names the row's own.

    One scan: the fact is added up by day and by month first, so that only months are expanded into subtotals.
    """
    months = (
        _by_key(star.fact, "date_key").join(star.dates, "date_key").groupBy("year", "quarter", "month")
        .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    )
    # The columns rolled up are set bits of the grouping, the month's the lowest.
    level = F.element_at(F.array(*map(F.lit, ("month", "quarter", "year", "total"))), F.bit_count(F.grouping_id()) + 1)
    return (
        months.rollup("year", "quarter", "month")
        .agg(
            level.alias("level"), F.sum("n").alias("transactions"), F.sum("amount").alias("revenue"),
            _mean(F.sum("amount"), F.sum("n")).alias("avg_transaction"),
        )
    )


def top_customers(star: Star, n: int = 10) -> DataFrame:
    """The n customers with most revenue; equal revenue goes by customer key."""
    totals = _by_key(star.fact, "customer_key")
    leaders = (
        totals.join(star.customers.select("customer_key"), "customer_key", "left_semi")
        .orderBy(F.desc("amount"), "customer_key").limit(n)
    )
    return (
        leaders.join(star.customers, "customer_key")
        .select(
            "customer_key", "customer_id", "customer_name", "country", "customer_segment",
            F.col("amount").alias("total_revenue"), F.col("n").alias("order_count"),
        )
        .orderBy(F.desc("total_revenue"), "customer_key")
    )


def category_performance(star: Star) -> DataFrame:
    totals = _by_key(star.fact, "product_key")
    profit = F.col("amount") - F.col("units") * F.col("cost_price")
    return (
        totals.join(star.products, "product_key")
        .groupBy("category")
        .agg(
            F.sum("n").alias("transactions"),
            F.sum("units").alias("units_sold"),
            F.sum("amount").alias("revenue"),
            F.sum(profit).alias("profit"),
            _mean(F.sum("amount"), F.sum("n")).alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def weekend_sales(star: Star) -> DataFrame:
    days = _by_key(star.fact, "date_key")
    kind = F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday")
    return (
        days.join(star.dates, "date_key")
        .groupBy(kind.alias("day_type"))
        .agg(
            F.sum("n").alias("transactions"),
            F.sum("amount").alias("revenue"),
            _mean(F.sum("amount"), F.sum("n")).alias("avg_transaction"),
        )
    )


def segment_revenue(star: Star) -> DataFrame:
    """Customers and revenue per segment; one row per customer makes the count distinct."""
    totals = _by_key(star.fact, "customer_key")
    return (
        totals.join(star.customers, "customer_key")
        .groupBy("customer_segment")
        .agg(F.count("*").alias("customers"), F.sum("amount").alias("revenue"))
        .orderBy("customer_segment")
    )


def category_profit(star: Star) -> DataFrame:
    totals = _by_key(star.fact, "product_key")
    cost = F.col("units") * F.col("cost_price")
    return (
        totals.join(star.products, "product_key")
        .groupBy("category")
        .agg(
            F.sum("amount").alias("revenue"),
            F.sum(cost).alias("cost"),
            F.sum(F.col("amount") - cost).alias("profit"),
        )
        .orderBy(F.desc("profit"), "category")
    )
