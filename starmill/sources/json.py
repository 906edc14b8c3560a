"""JSON scans: records at the root or below a path, nested objects flattened."""

import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import flat_columns, quoted
from starmill.sources.csv import one_split_each
from starmill.sources.documents import split_elements
from starmill.sources.order import file_place, place
from starmill.workspace import Files, materialize


def document_order(record: Any) -> list[str]:
    """Flattened names of a record: plain fields as written, then the nested ones."""
    def below(value: dict, root: str) -> list[str]:
        names = []
        for key, inner in value.items():
            name = f"{root}.{key}"
            names += below(inner, name) if isinstance(inner, dict) else [name]
        return names

    if not isinstance(record, dict):
        return []
    plain = [k for k, v in record.items() if not isinstance(v, dict)]
    nested = [n for k, v in record.items() if isinstance(v, dict) for n in below(v, k)]
    return plain + nested


def _first_record(
    spark: SparkSession, path: str | list[str], lines: bool, pointer: str
) -> Any:
    """The first record of the first file, read to learn the written order of its fields."""
    texts = spark.read.text(path, wholetext=not lines)
    found = (
        texts.where(F.length(F.trim("value")) > 0).limit(1)
        .select(F.get_json_object("value", pointer).alias("record")).first()
    )
    return json.loads(found["record"]) if found and found["record"] else None


def read_json(
    spark: SparkSession,
    path: str | list[str],
    record_path: str | list[str] | None = None,
    meta: list[str | list[str]] | None = None,
    lines: bool = False,
    columns: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan JSON documents, or one record per line with ``lines=True``.

    A root array gives a row per element, a root object one row. With
    ``record_path`` a root object gives a row per element of the array there,
    and the ``meta`` fields of the object repeat on each. Malformed input
    raises. Columns come in written order; ``columns`` names it without a look
    at the first record. Types are inferred in a pass over the data; ``schema``
    gives them without one. Root arrays larger than a split are read by many
    tasks (``documents``); a large root object is one task's, so what lies below
    its ``record_path`` should be delivered as lines.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        if not lines and not one_split_each(spark, path):
            files = Files(spark)
            first = path if isinstance(path, str) else path[0]
            if files.first_char(files.first_file(first)) == "[":
                return _read_split(spark, path, columns, schema)
        docs = reader.json(path, multiLine=not lines, mode="FAILFAST")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"JSON file not found: {path}") from error
        raise

    files = Files(spark)
    first = path if isinstance(path, str) else path[0]
    root = "{" if lines else files.first_char(files.first_file(first))
    if root not in "{[":
        raise ValueError(f"Unsupported JSON structure in {first}")
    if record_path and root == "{":
        steps = [record_path] if isinstance(record_path, str) else list(record_path)
        parents = {}
        for field in meta or []:
            where = [field] if isinstance(field, str) else list(field)
            known = _has(docs.schema, where)
            column = F.col(quoted(where)) if known else F.lit(None).cast("string")
            parents[".".join(where)] = column
        picked = docs.select(
            F.explode(F.col(quoted(steps))).alias("record"),
            *[c.alias(f"meta {n}") for n, c in parents.items()],
            F.col("_metadata.file_name").alias("_source_file"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        element = picked.schema["record"].dataType
        if isinstance(element, T.StructType):
            below = flat_columns(element, ("record",))
            named = {n.removeprefix("record."): c for n, c in below.items()}
        else:
            named = {"0": F.col("record")}
        order = columns
        if order is None:
            pointer = "$." + ".".join(steps) + "[0]"
            order = document_order(_first_record(spark, path, lines, pointer))
        names = [n for n in order if n in named] + [n for n in named if n not in order]
        return picked.select(
            *[named[n].alias(n) for n in names],
            *[F.col(f"`meta {n}`").alias(n) for n in parents],
            "_source_file",
            F.lit("JSON").alias("_source_type"),
            place(0, F.col("file_path"), F.col("block"), F.monotonically_increasing_id()),
        )

    order = columns
    if order is None:
        order = document_order(_first_record(spark, path, lines, "$" if root == "{" else "$[0]"))
    leaves = flat_columns(docs.schema)
    names = [n for n in order if n in leaves] + [n for n in leaves if n not in order]
    return docs.select(
        *[leaves[n].alias(n) for n in names],
        F.col("_metadata.file_name").alias("_source_file"),
        F.lit("JSON").alias("_source_type"),
        file_place(),
    )


def _read_split(
    spark: SparkSession, path: str | list[str], columns: list[str] | None, schema: T.StructType | None
) -> DataFrame:
    """Root arrays whose elements were cut apart by many tasks."""
    records = materialize(split_elements(spark, path), "records")
    if schema is None:
        texts = getattr(records.select("record")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        reader = spark.read.option("mode", "FAILFAST")._jreader
        schema = DataFrame(reader.json(texts), spark).schema
    order = columns
    if order is None:
        first = records.orderBy("file", "block", "row").select("record").first()
        order = document_order(json.loads(first["record"])) if first else []
    parsed = records.withColumn("record", F.from_json("record", schema, {"mode": "FAILFAST"}))
    leaves = {n.removeprefix("record."): c for n, c in flat_columns(schema, ("record",)).items()}
    names = [n for n in order if n in leaves] + [n for n in leaves if n not in order]
    return parsed.select(
        *[leaves[n].alias(n) for n in names],
        F.col("name").alias("_source_file"),
        F.lit("JSON").alias("_source_type"),
        place(0, F.col("file"), F.col("block"), F.col("row")),
    )


def _has(schema: T.DataType, path: list[str]) -> bool:
    for step in path:
        if not isinstance(schema, T.StructType) or step not in schema.fieldNames():
            return False
        schema = schema[step].dataType
    return True
