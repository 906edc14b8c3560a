"""Flat tables and file exports."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.clean import drop_metadata
from starmill.workspace import Files

WRITE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
NESTED = (T.ArrayType, T.StructType, T.MapType)


class FlatStore:
    """Parquet tables below one folder, written without lineage columns."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def load(self, df: DataFrame, table: str, if_exists: str = "replace") -> int:
        """Write the data columns and return the number of rows written.

        ``if_exists`` is replace, append or fail. Counts come from file footers.
        """
        before = self.row_count(table) if if_exists == "append" and self.exists(table) else 0
        try:
            drop_metadata(df).write.mode(WRITE_MODES[if_exists]).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() == "PATH_ALREADY_EXISTS":
                raise FileExistsError(f"table '{table}' exists") from error
            raise
        return self.row_count(table) - before

    def exists(self, table: str) -> bool:
        return Files(self.spark).exists(self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def row_count(self, table: str) -> int:
        return self.read(table).count()


def epoch_millis(c: Column) -> Column:
    """Milliseconds since 1970 of a date or zoneless timestamp, whatever the session zone."""
    clock = F.hour(c) * 3600 + F.minute(c) * 60
    second = F.extract(F.lit("SECOND"), c)
    days = F.unix_date(c.cast("date")).cast("long")
    return days * 86400000 + clock.cast("long") * 1000 + F.floor(second * 1000).cast("long")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header each, lineage columns included."""
    shown = df.drop("_ord")
    shown = shown.select(*[
        F.to_json(c).alias(c) if isinstance(shown.schema[c].dataType, NESTED) else F.col(c)
        for c in shown.columns
    ])
    (
        shown.write.mode("overwrite")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(
            path, header=True, encoding="UTF-8", escape='"',
            timestampFormat="yyyy-MM-dd HH:mm:ss",
        )
    )


def export_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, nulls written, dates as epoch milliseconds."""
    shown = df.drop("_ord")
    shown = shown.select(*[
        epoch_millis(F.col(c).cast("timestamp_ntz")).alias(c)
        if isinstance(shown.schema[c].dataType, TEMPORAL) else F.col(c)
        for c in shown.columns
    ])
    shown.write.mode("overwrite").json(path, ignoreNullFields=False, encoding="UTF-8")
