"""The place of a row in its source: ``_ord``, captured in the scan before any shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def place(source: int, file: Column, block: Column, row: Column) -> Column:
    """Orders rows by source, file, byte block and position, whatever task reads them."""
    return F.struct(
        F.lit(source).alias("source"),
        file.cast("string").alias("file"),
        block.cast("long").alias("block"),
        row.cast("long").alias("row"),
    ).alias("_ord")


def file_place(source: int = 0) -> Column:
    return place(
        source,
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )


def as_source(df: DataFrame, source: int) -> DataFrame:
    """The same rows, placed as the given source of a union."""
    if "_ord" not in df.columns:
        return df
    return df.withColumn("_ord", F.col("_ord").withField("source", F.lit(source)))


def unordered(df: DataFrame) -> DataFrame:
    return df.drop("_ord")
