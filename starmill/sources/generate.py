"""Sample sales: every value is a function of the row's id, so a lost task repeats them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.samples import (
    COUNTRIES,
    CUSTOMER_NAMES,
    DAYS,
    DISCOUNTS,
    FIRST_DAY,
    PRODUCTS,
)


def draw(what: str, n: int) -> Column:
    """A whole number below n, drawn from the id for one purpose."""
    digest = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{what}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def nth(values: list, place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


def numbered(prefix: str, n: Column, width: int) -> Column:
    text = n.cast("string")
    return F.concat(
        F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))
    )


def by_share(shares: dict, place: Column) -> Column:
    """The value whose share of a hundred holds the place."""
    return nth([value for value, share in shares.items() for _ in range(share)], place)


def sample_sales(ids: DataFrame, customers: int = 200, products: int = 100) -> DataFrame:
    """One sale per row of ``ids`` (a long column ``id``)."""
    drawn = ids.select(
        "id",
        draw("customer", customers).alias("customer"),
        draw("product", products).alias("product"),
        by_share({c: share for c, (share, _) in COUNTRIES.items()}, draw("country", 100))
        .alias("country"),
        (draw("quantity", 5) + 1).cast("int").alias("quantity"),
        ((draw("price", 199001) + 1000).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(18,2)").alias("unit_price"),
        by_share(DISCOUNTS, draw("discount", 100)).alias("discount"),
    )
    city = None
    for country, (_, cities) in COUNTRIES.items():
        here = F.col("country") == country
        picked = nth(cities, draw("city", len(cities)))
        city = F.when(here, picked) if city is None else city.when(here, picked)
    name = nth(CUSTOMER_NAMES, F.col("customer") % len(CUSTOMER_NAMES))
    kind = F.col("product") % len(PRODUCTS)
    product = {
        column: nth([p[i] for p in PRODUCTS], kind)
        for i, column in enumerate(["product_name", "category", "subcategory", "brand"])
    }
    hundredths = F.col("quantity") * (100 - F.col("discount"))
    total = F.col("unit_price") * hundredths * F.lit("0.01").cast("decimal(3,2)")
    return drawn.select(
        numbered("ORD", F.col("id") + 1, 6).alias("order_id"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), draw("day", DAYS).cast("int"))
        .cast("string").alias("order_date"),
        numbered("C", F.col("customer") + 1, 4).alias("customer_id"),
        name.alias("customer_name"),
        F.concat(F.lower(F.replace(name, F.lit(" "), F.lit("."))), F.lit("@email.com"))
        .alias("email"),
        "country",
        city.alias("city"),
        numbered("P", F.col("product") + 1, 4).alias("product_id"),
        *[c.alias(n) for n, c in product.items()],
        "quantity",
        "unit_price",
        "discount",
        total.cast("decimal(18,2)").alias("total_amount"),
    )


def generate_sales(spark: SparkSession, rows: int = 1000) -> DataFrame:
    return sample_sales(spark.range(rows))
