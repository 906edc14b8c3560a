"""SQL sources: catalog tables and views, or a database behind JDBC."""

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.numbering import number_rows
from starmill.sources.order import place


def _tagged(df: DataFrame, db: str, order_by: list[str] | None) -> DataFrame:
    """Lineage columns, and the order of the rows where the source names one."""
    if order_by:
        df = number_rows(df, order_by, "_row", start=0)
        row = F.col("_row")
    else:
        row = F.monotonically_increasing_id()
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c != "_row"],
        F.lit("SQL").alias("_source_type"),
        F.lit(db).alias("_source_db"),
        place(0, F.lit(""), F.lit(0), row),
    )


def _here(spark: SparkSession) -> str:
    return f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}"


def read_query(
    spark: SparkSession, query: str, params: dict[str, Any] | list[Any] | None = None,
    db: str | None = None, order_by: list[str] | None = None,
) -> DataFrame:
    """Rows of a query with bound parameters, from the catalog or from a JDBC url."""
    if db is None:
        return _tagged(spark.sql(query, args=params), _here(spark), order_by)
    if params:
        raise ValueError("a query sent to a database takes no parameters")
    rows = spark.read.format("jdbc").option("url", db).option("query", query).load()
    return _tagged(rows, db, order_by)


def read_table(
    spark: SparkSession, table: str, where: str | None = None, db: str | None = None,
    order_by: list[str] | None = None, split: dict[str, Any] | None = None,
) -> DataFrame:
    """A whole table, or the rows a predicate keeps; the predicate is pushed down.

    ``split`` (column, lower, upper, parts) reads a database table in parallel ranges.
    """
    if db is None:
        rows = spark.table(table)
    else:
        reader = spark.read.format("jdbc").option("url", db).option("dbtable", table)
        if split:
            reader = (
                reader.option("partitionColumn", split["column"])
                .option("lowerBound", split["lower"])
                .option("upperBound", split["upper"])
                .option("numPartitions", split["parts"])
            )
        rows = reader.load()
    if where:
        rows = rows.where(where)
    return _tagged(rows, db or _here(spark), order_by)


def list_tables(spark: SparkSession) -> DataFrame:
    """Names and kinds of the tables and views a query can reach."""
    rows = [(t.name, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_name string, is_temporary boolean")
