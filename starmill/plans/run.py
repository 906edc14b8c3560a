"""A whole run: extract, clean, validate, deduplicate, load, report."""

import json
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.clean import clean, data_columns
from starmill.operators.dedup import add_row_hash, deduplicate
from starmill.operators.profile import cell_bytes, quality_report, report_dict
from starmill.operators.sinks import FlatStore, export_csv, export_json
from starmill.operators.validate import measures, report_from
from starmill.plans.star_load import load_star
from starmill.plans.warehouse import Warehouse
from starmill.sources.extract import extract
from starmill.workspace import Files, materialize, temporary_tables

DEFAULT_SPEC = {
    "sources": [],
    "cleaning": {"null_strategy": "fill"},
    "deduplication": {"keep": "first"},
    "validation_rules": {},
    "output": {"table_name": "etl_results", "export_csv": True, "export_json": False},
}


def read_spec(spark: SparkSession, path: str) -> dict[str, Any]:
    """A spec from a JSON file, or from YAML where a YAML reader is installed."""
    text = Files(spark).read_text(path)
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


class Clock:
    """Seconds per phase."""

    def __init__(self):
        self.begun = self.last = time.monotonic()
        self.phases: dict[str, float] = {}

    def mark(self, phase: str) -> None:
        now = time.monotonic()
        self.phases[f"{phase}_time"] = round(now - self.last, 2)
        self.last = now

    def total(self) -> float:
        return time.monotonic() - self.begun


def staged_clean(landed: DataFrame, spec: dict[str, Any]) -> DataFrame:
    return clean(landed, spec.get("cleaning", {}))


def staged_dedup(cleaned: DataFrame, spec: dict[str, Any]) -> DataFrame:
    """Deduplicated rows; only the rows that stay get a fingerprint."""
    options = spec.get("deduplication", {})
    kept = deduplicate(cleaned, options.get("subset"), options.get("keep", "first"))
    return add_row_hash(kept) if options.get("use_hash", True) else kept


def run(spark: SparkSession, spec: dict[str, Any] | None = None) -> dict[str, Any]:
    """Run a spec and return its report; a run that fails reports why.

    Three tables are written on the way, each read several times after: the
    landed sources, the clean and deduplicated rows, the loaded result.
    Counts come from aggregates over those tables, not from task counters,
    which would count a repeated task twice.
    """
    with temporary_tables(spark):
        return _run(spark, DEFAULT_SPEC if spec is None else spec)


def _run(spark: SparkSession, spec: dict[str, Any]) -> dict[str, Any]:
    clock = Clock()
    try:
        found = extract(spark, spec)
        if found.rows is None:
            return {
                "status": "failed", "reason": "Empty extract",
                "failed_sources": found.failed, "metrics": clock.phases,
            }
        landed = materialize(found.rows, "landed")
        rows_extracted = landed.count()
        clock.mark("extract")
        if not rows_extracted:
            return {"status": "failed", "reason": "Empty extract", "metrics": clock.phases}

        cleaned = materialize(staged_clean(landed, spec), "cleaned")
        with_duplicates = spec.get("count_duplicates", True)
        quality = report_dict(quality_report(cleaned.drop("_ord"), with_duplicates))
        clock.mark("clean")

        rules = spec.get("validation_rules", {})
        aggregates = measures(cleaned, rules)
        counts = cleaned.agg(*aggregates).first().asDict() if aggregates else {}
        validation = report_from(cleaned, rules, counts)
        clock.mark("validate")

        staged = materialize(staged_dedup(cleaned, spec), "staged")
        size = sum(
            (cell_bytes(F.col(c), staged.schema[c].dataType) for c in data_columns(staged)),
            F.lit(0),
        )
        kept = staged.agg(F.count("*").alias("n"), F.sum(size.cast("long")).alias("size")).first()
        clock.mark("deduplicate")

        report: dict[str, Any] = {}
        output = spec.get("output", {})
        root = output.get("path") or output["db_path"]
        if spec.get("use_star_schema", False):
            warehouse = Warehouse(spark, root, spec.get("money", "double"))
            loaded = load_star(warehouse, staged)
            rows_loaded = loaded.facts["rows_loaded"]
            report["star"] = vars(loaded)
        else:
            table = output.get("table_name", "etl_results")
            store = FlatStore(spark, root)
            rows_loaded = store.load(staged, table, output.get("if_exists", "replace"))
            if output.get("export_csv"):
                export_csv(staged, f"{root}/{table}_csv")
            if output.get("export_json"):
                export_json(staged, f"{root}/{table}_json")
        clock.mark("load")

        total = clock.total()
        return {
            "status": "success",
            "elapsed_seconds": round(total, 2),
            "rows_extracted": rows_extracted,
            "rows_cleaned": quality["total_rows"],
            "rows_after_cleaning": kept["n"],
            "duplicates_removed": quality["total_rows"] - kept["n"],
            "rows_loaded": rows_loaded,
            "failed_sources": found.failed,
            "quality_report": quality,
            "validation": validation,
            "performance": {
                **clock.phases,
                "total_time": round(total, 2),
                "throughput": round(rows_loaded / total),
                "data_size_mb": round((kept["size"] or 0) / (1 << 20), 2),
            },
            **report,
        }
    except Exception as error:
        return {
            "status": "failed", "error": str(error),
            "elapsed_seconds": round(clock.total(), 2), "metrics": clock.phases,
        }
