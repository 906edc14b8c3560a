"""Reports over whole tables: quality, profile, statistics, uniqueness, lineage."""

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import missing
from starmill.functions.text import row_digest

FIXED_BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def percent(part: Column, whole: Column) -> Column:
    """Share in percent to two places, ties to even; 0 of nothing is 0."""
    return F.when(whole > 0, F.rint(part / whole * 100 * 100) / 100).otherwise(0.0)


def quality_report(df: DataFrame, duplicates: bool = True) -> DataFrame:
    """One row per column: type, nulls and their share, and the table's row counts.

    Rows are told apart by a digest, so what is shuffled is a few bytes per
    distinct row however wide the table is; which cells are null rides along.
    """
    columns = df.columns
    gaps = F.concat(*[
        F.when(missing(F.col(f"`{c}`"), df.schema[c].dataType), "1").otherwise("0") for c in columns
    ]).alias("gaps")
    if duplicates:
        digest = row_digest({f.name: f.dataType for f in df.schema.fields})
        groups = df.select(digest.alias("row"), gaps).groupBy("row", "gaps")
    else:
        groups = df.select(gaps).groupBy("gaps")
    totals = groups.agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_rows"),
        *[
            F.coalesce(F.sum(F.when(F.substring("gaps", i + 1, 1) == "1", F.col("n"))), F.lit(0))
            .alias(f"n{i}")
            for i in range(len(columns))
        ],
    )
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").alias("null_count"),
        )
        for i, c in enumerate(columns)
    ]
    return totals.select(
        F.inline(F.array(*per_column)), "total_rows", "distinct_rows"
    ).select(
        "column_name",
        "data_type",
        "null_count",
        percent(F.col("null_count"), F.col("total_rows")).alias("null_percent"),
        "total_rows",
        F.lit(len(columns)).alias("total_columns"),
        *([(F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows")]
          if duplicates else []),
    )


def report_dict(report: DataFrame) -> dict[str, Any]:
    """The per-column report as one nested dict; it has one row per column."""
    rows = report.collect()
    out = {
        "total_rows": rows[0]["total_rows"] if rows else 0,
        "total_columns": len(rows),
        "null_counts": {r["column_name"]: r["null_count"] for r in rows},
        "null_percent": {r["column_name"]: r["null_percent"] for r in rows},
        "data_types": {r["column_name"]: r["data_type"] for r in rows},
    }
    if rows and "duplicate_rows" in rows[0]:
        out["duplicate_rows"] = rows[0]["duplicate_rows"]
    return out


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column of a stored table, with its nulls and the nulls of the table."""
    counted = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(missing(F.col(c), df.schema[c].dataType)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    total_nulls = sum((F.col(f"n{i}") for i in range(len(df.columns))), F.lit(0))
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").alias("null_count"),
        )
        for i, c in enumerate(df.columns)
    ])
    return counted.select(
        F.inline(rows),
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        total_nulls.alias("total_nulls"),
    )


def cell_bytes(c: Column, dtype: T.DataType) -> Column:
    """Bytes of a value: its UTF-8 length for text, the width of its type otherwise."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return F.lit(FIXED_BYTES.get(dtype.simpleString(), 8))


def dimension_stats(df: DataFrame, name: str) -> DataFrame:
    """One row: rows, columns, names, nulls per column and megabytes of the values."""
    size = sum((cell_bytes(F.col(c), df.schema[c].dataType) for c in df.columns), F.lit(0))
    return df.agg(
        F.count("*").alias("row_count"),
        F.sum(size.cast("long")).alias("bytes"),
        *[F.count_if(missing(F.col(c), df.schema[c].dataType)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    ).select(
        F.lit(name).alias("dimension"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.concat_ws(",", *[
            F.concat(F.lit(f"{c}="), F.col(f"n{i}").cast("string"))
            for i, c in enumerate(df.columns)
        ]).alias("null_counts"),
        (F.rint(F.coalesce("bytes", F.lit(0)) / float(1 << 20) * 100) / 100).alias("memory_mb"),
    )


def source_breakdown(df: DataFrame) -> DataFrame:
    """Rows per source type, most first."""
    return (
        df.groupBy("_source_type").agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), "_source_type")
    )


def uniqueness(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row: whether every row has its own key, and the message that says so."""
    counted = df.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(key).alias("unique_keys"),
    )
    extra = F.col("total_rows") - F.col("unique_keys")
    return counted.select(
        F.lit(name).alias("dimension"),
        "total_rows",
        "unique_keys",
        (extra == 0).alias("is_valid"),
        F.when(extra != 0, F.concat(
            F.lit(f"{name}: "), extra.cast("string"), F.lit(f" duplicate keys found in {key}")
        )).otherwise(F.concat(
            F.lit(f"{name}: ✓ All "), F.col("total_rows").cast("string"),
            F.lit(" keys are unique"),
        )).alias("message"),
    )


def table_info(df: DataFrame, name: str) -> DataFrame:
    """One row per column of a table, with the table's row count."""
    columns = F.array(*[
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.inline(columns)
    )


def page(df: DataFrame, order_by: list[str], number: int = 1, size: int = 20) -> DataFrame:
    """Page ``number`` of the rows in a given order. ``df.count()`` is the total."""
    return df.orderBy(*order_by).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, key: str, last: Any, size: int = 20) -> DataFrame:
    """The page after the row with key ``last``; skips nothing row by row, so any depth is cheap."""
    return df.where(F.col(key) > F.lit(last)).orderBy(key).limit(size)


def referential_orphans(fact: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """One row per foreign key: fact rows whose key the parent table lacks.

    The fact is counted by key before it meets a parent, so a key that holds a
    third of the fact reaches the join as one row.
    """
    found = []
    for key, parent in parents.items():
        orphans = (
            fact.groupBy(key).agg(F.count("*").alias("n"))
            .join(parent.select(key), key, "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
        )
        found.append(orphans.select(F.lit(key).alias("foreign_key"), "orphans"))
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out
