"""Duplicate removal, row fingerprints and the duplicate report."""

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import text
from starmill.operators.clean import data_columns
from starmill.operators.numbering import sort_columns

log = logging.getLogger(__name__)


def key_columns(df: DataFrame, subset: list[str] | None) -> list[str]:
    """The columns that define a duplicate: the subset's present ones, or all data columns."""
    if subset is None:
        return data_columns(df)
    present = [c for c in subset if c in df.columns]
    if len(present) < len(subset):
        log.warning("dedup columns not found: %s", [c for c in subset if c not in present])
    if not present:
        raise ValueError(f"none of the dedup columns {subset} exist")
    return present


def deduplicate(
    df: DataFrame,
    subset: list[str] | None = None,
    keep: str | bool = "first",
    order_by: list[str | Column] | None = None,
) -> DataFrame:
    """Keep the first, the last or (``keep=False``) no row of each group of equal keys.

    Nulls are equal to each other. Order is ``_ord`` unless given. The rank
    limit lets Spark drop all but the leading rows of a key before the shuffle,
    so a key with a third of the table sends one or two rows per input task.
    """
    keys = key_columns(df, subset)
    order = sort_columns(df, order_by or ["_ord"])
    if keep == "last":
        order = [c.desc() for c in order]
    same = Window.partitionBy(*keys)
    rank = F.row_number().over(same.orderBy(*order))
    if keep is False:
        # Two rows are enough to know that a key repeats.
        leading = df.withColumn("_rank", rank).where("_rank <= 2")
        return (
            leading.withColumn("_rank", F.max("_rank").over(same))
            .where("_rank = 1").drop("_rank")
        )
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def row_hash(df: DataFrame) -> Column:
    """SHA-256 over the texts of the data columns, in column order."""
    parts = []
    for c in data_columns(df):
        dtype = df.schema[c].dataType
        parts.append(F.coalesce(text.value_text(F.col(c), dtype), F.lit(text.null_text(dtype))))
    return F.sha2(F.concat_ws("|", *parts), 256)


def add_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("_row_hash", row_hash(df))


def duplicate_report(df: DataFrame, subset: list[str] | None = None) -> dict[str, float]:
    """Rows, rows in any group of duplicates, the others, and the share in percent."""
    keys = key_columns(df, subset or None)
    digest = text.row_digest({c: df.schema[c].dataType for c in keys})
    groups = df.groupBy(*keys) if subset else df.select(digest.alias("row")).groupBy("row")
    groups = groups.agg(F.count("*").alias("n"))
    total, repeated = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)),
    ).first()
    return {
        "total_rows": total,
        "duplicate_rows": repeated,
        "unique_rows": total - repeated,
        "duplicate_percent": round(repeated / total * 100, 2) if total else 0.0,
    }
