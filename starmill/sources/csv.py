"""CSV scans: every cell is text, and the usual spellings of nothing are null."""

import codecs
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.fixed import CSV_NULLS
from starmill.sources.order import file_place, place
from starmill.sources.records import BLANK, names_of, split_records, walk
from starmill.workspace import Files

# Spark's names of the encodings it reads, by the codec name Python gives them.
CHARSETS = {
    "utf-8": "UTF-8", "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1", "utf-16": "UTF-16",
    "utf-16-be": "UTF-16BE", "utf-16-le": "UTF-16LE", "utf-32": "UTF-32",
}


def charset(encoding: str) -> str:
    return CHARSETS.get(codecs.lookup(encoding).name, encoding)


def one_split_each(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether no file is larger than the smallest split Spark makes; only the listing is read."""
    limit = min(_bytes(spark, "spark.sql.files.maxPartitionBytes"), _bytes(spark, "spark.sql.files.openCostInBytes"))
    return spark.read.format("binaryFile").load(path).where(F.col("length") > limit).isEmpty()


def _bytes(spark: SparkSession, setting: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))


def first_file(spark: SparkSession, path: str | list[str]) -> str:
    first = path if isinstance(path, str) else path[0]
    return first if Files(spark).exists(first) else spark.read.text(path).inputFiles()[0]


def is_wide(encoding: str) -> bool:
    """Whether characters have several bytes each, so that text cannot be split at a line feed's byte."""
    return charset(encoding).startswith(("UTF-16", "UTF-32"))


def first_record(spark: SparkSession, path: str, delimiter: str, encoding: str) -> str:
    """The header of a file: its first record that is not blank."""
    record, inside = "", False
    for line in Files(spark).lines(path):
        if is_wide(encoding):
            return line
        line = line.encode("ISO-8859-1").decode(encoding, "replace").removeprefix("\ufeff")
        if not inside and not line.strip(BLANK):
            continue
        record = f"{record}\n{line}" if inside else line
        _, inside = walk(line, inside, delimiter)
        if not inside:
            break
    return record


def or_null(cell: Column) -> Column:
    return F.when(~cell.isin(*CSV_NULLS), cell)


def parsed(records: DataFrame, columns: list[str], delimiter: str, *extra: Column) -> DataFrame:
    """The cells of records, which are one row each, and where they came from."""
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    cells = F.from_csv("record", schema, {"sep": delimiter, "quote": '"', "escape": '"'})
    return records.withColumn("cells", cells).select(
        *(or_null(F.col(f"cells.c{i}")).alias(c) for i, c in enumerate(columns)),
        F.col("name").alias("_source_file"), F.lit("CSV").alias("_source_type"), *extra,
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    encoding: str = "utf-8",
    multiline: bool | None = None,
) -> DataFrame:
    """Scan CSV files that share one header, or the .csv files of a folder.

    Cells may hold line breaks inside quotes, and files are split between tasks
    all the same: ``records`` has the rule, which is one for all files. Files
    larger than a split are gone through once more beforehand; ``multiline=False``
    says that no cell of theirs holds a line break and saves that. A file whose
    header differs from the first one's is an error.
    """
    if isinstance(path, str) and Files(spark).is_dir(path):
        united = read_csv_directory(spark, path, delimiter, encoding, multiline)
        if united is None:
            raise FileNotFoundError(f"no CSV file in: {path}")
        return united
    try:
        if multiline is not False and not is_wide(encoding):
            small = one_split_each(spark, path)
            header = first_record(spark, first_file(spark, path), delimiter, encoding)
            records = split_records(spark, path, charset(encoding), delimiter, names_of(header, delimiter), small)
            if records is not None:
                columns = spark.read.csv(
                    spark.sparkContext.parallelize([header], 1), header=True, sep=delimiter, quote='"', escape='"'
                ).columns
                return parsed(records, columns, delimiter, place(0, F.col("file"), F.col("block"), F.col("row")))
        # Every line is a row, or the encoding leaves no bytes to split at.
        raw = spark.read.csv(
            path, header=True, sep=delimiter, encoding=charset(encoding), quote='"', escape='"',
            multiLine=is_wide(encoding) and multiline is not False, inferSchema=False, enforceSchema=False,
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"CSV input not found: {path}") from error
        raise
    return raw.select(
        *(or_null(F.col(f"`{c}`")).alias(c) for c in raw.columns),
        F.col("_metadata.file_name").alias("_source_file"),
        F.lit("CSV").alias("_source_type"),
        file_place(),
    )


def read_csv_directory(
    spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8",
    multiline: bool | None = None,
) -> DataFrame | None:
    """Scan every .csv file of a folder; None if it has none.

    Files are grouped by header, so a thousand files with one header are one
    scan; groups with different headers are united by column name.
    """
    files = Files(spark)
    if not files.is_dir(path):
        raise NotADirectoryError(f"no folder at: {path}")
    paths = [f"{path}/{n}" for n in files.names(path) if n.lower().endswith(".csv")]
    if not paths:
        return None
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda p: first_record(spark, p, delimiter, encoding), paths))
    scans = [
        read_csv(
            spark, [p for p, h in zip(paths, headers) if h == header],
            delimiter, encoding, multiline,
        )
        for header in dict.fromkeys(headers)
    ]
    united = scans[0]
    for scan in scans[1:]:
        united = united.unionByName(scan, allowMissingColumns=True)
    return united
