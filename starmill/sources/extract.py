"""Many sources into one table, as a spec lists them."""

import logging
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.text import value_text
from starmill.sources.csv import read_csv
from starmill.sources.json import read_json
from starmill.sources.order import as_source
from starmill.sources.sql import read_query, read_table

log = logging.getLogger(__name__)


@dataclass
class Extract:
    """The united rows (None if nothing was read) and what went wrong on the way."""

    rows: DataFrame | None
    failed: list[str] = field(default_factory=list)


def _open(spark: SparkSession, source: dict[str, Any]) -> DataFrame | None:
    kind = source.get("type", "").upper()
    if kind == "CSV":
        options = {k: source[k] for k in ("delimiter", "encoding", "multiline") if k in source}
        return read_csv(spark, source.get("path", ""), **options)
    if kind == "JSON":
        names = ("record_path", "meta", "lines", "columns", "schema")
        return read_json(
            spark, source.get("path", ""), **{k: source[k] for k in names if k in source}
        )
    if kind == "SQL":
        def options(*names: str) -> dict[str, Any]:
            return {k: source[k] for k in ("order_by", *names) if k in source}

        if source.get("query"):
            return read_query(spark, source["query"], db=source.get("path"), **options("params"))
        if source.get("table"):
            return read_table(
                spark, source["table"], db=source.get("path"), **options("where", "split")
            )
        raise ValueError("SQL source must specify 'table' or 'query'")
    log.warning("unknown source type %s, skipped", kind)
    return None


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows; a column a source lacks is null, a type two sources dispute becomes text."""
    types: dict[str, set[str]] = {}
    for frame in frames:
        for f in frame.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    disputed = {name for name, seen in types.items() if len(seen) > 1}

    def agreed(frame: DataFrame) -> DataFrame:
        return frame.select(*[
            value_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
            if f.name in disputed else F.col(f"`{f.name}`")
            for f in frame.schema.fields
        ])

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [agreed(f) for f in frames]
    )


def extract(spark: SparkSession, spec: dict[str, Any]) -> Extract:
    """Open every source lazily and unite them by column name.

    A source that cannot be opened, or whose first row cannot be read, is
    recorded and left out; in ``strict`` mode it ends the run.
    """
    frames, failed = [], []
    for place, source in enumerate(spec.get("sources", [])):
        try:
            frame = _open(spark, source)
            if frame is not None:
                frame.limit(1).collect()
                frames.append(as_source(frame, place))
        except Exception as error:
            label = f"{source.get('type', '').upper()} source '{source.get('path', '')}'"
            failed.append(f"{label}: {error}")
            log.error("extract failed: %s", failed[-1])
            if spec.get("validation_mode", "permissive") == "strict":
                raise
    return Extract(union_by_name(frames) if frames else None, failed)
