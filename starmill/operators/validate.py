"""Validation rules compiled to predicates: one aggregate counts them all."""

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import text
from starmill.functions.columns import missing


@dataclass
class Check:
    """One rule on one column; ``broken`` is true for a row that violates it."""

    column: str
    rule: str
    broken: Column
    message: str  # what follows the count


def java_pattern(pattern: str) -> str:
    """The pattern anchored at the start, with Unicode classes, in Java's spelling."""
    pattern = re.sub(r"\(\?P<", "(?<", pattern)
    pattern = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern)
    return f"(?U)^(?:{pattern})".replace(r"\Z", r"\z")


def checks(df: DataFrame, rules: dict[str, dict[str, Any]]) -> list[Check]:
    """The rules that can be evaluated on the columns present."""
    out = []
    for c, rule in rules.items():
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        here = F.col(c)
        value = text.number(here, dtype)
        word = text.value_text(here, dtype)
        if rule.get("required"):
            out.append(Check(c, "required", missing(here, dtype), "null value(s)"))
        if "min_value" in rule:
            low = rule["min_value"]
            out.append(Check(c, "min_value", value < low, f"value(s) below min ({low})"))
        if "max_value" in rule:
            high = rule["max_value"]
            out.append(Check(c, "max_value", value > high, f"value(s) above max ({high})"))
        if "allowed_values" in rule:
            allowed = rule["allowed_values"]
            out.append(Check(
                c, "allowed_values", ~word.isin(*[str(v) for v in allowed]),
                f"value(s) not in allowed set {allowed}",
            ))
        if "regex" in rule:
            pattern = rule["regex"]
            out.append(Check(
                c, "regex", ~word.rlike(java_pattern(pattern)),
                f"value(s) do not match pattern '{pattern}'",
            ))
        if "min_length" in rule:
            least = rule["min_length"]
            out.append(Check(
                c, "min_length", F.length(word) < least, f"value(s) shorter than {least} chars"
            ))
        if "max_length" in rule:
            most = rule["max_length"]
            out.append(Check(
                c, "max_length", F.length(word) > most, f"value(s) longer than {most} chars"
            ))
    return out


def measures(df: DataFrame, rules: dict[str, dict[str, Any]]) -> list[Column]:
    """Aggregates that count the violations of each check, named after it."""
    return [F.count_if(k.broken).alias(f"{k.rule} {k.column}") for k in checks(df, rules)]


def report_from(
    df: DataFrame, rules: dict[str, dict[str, Any]], counts: dict[str, int]
) -> dict[str, Any]:
    """The report, from counts of each check that some pass over the data produced."""
    violations: dict[str, list[str]] = {}
    for c, rule in rules.items():
        if c not in df.columns:
            absent = [f"Column '{c}' is missing from dataset"] if rule.get("required") else []
            violations[c] = absent
    for k in checks(df, rules):
        n = counts.get(f"{k.rule} {k.column}", 0)
        if n:
            prefix = "Required column has " if k.rule == "required" else ""
            violations.setdefault(k.column, []).append(f"{prefix}{n} {k.message}")
    total = sum(len(messages) for messages in violations.values())
    return {"passed": total == 0, "total_violations": total, "violations": violations}


def validate(df: DataFrame, rules: dict[str, dict[str, Any]]) -> dict[str, Any]:
    """Check every rule in one pass over the table."""
    aggregates = measures(df, rules)
    counts = df.agg(*aggregates).first().asDict() if aggregates else {}
    return report_from(df, rules, counts)


def violation_table(df: DataFrame, rules: dict[str, dict[str, Any]]) -> DataFrame:
    """One row per check with its number of violations and the report's message."""
    found = checks(df, rules)
    counted = df.agg(*[F.count_if(k.broken).alias(f"n{i}") for i, k in enumerate(found)])
    rows = []
    for i, k in enumerate(found):
        n = F.col(f"n{i}")
        prefix = "Required column has " if k.rule == "required" else ""
        message = F.concat(F.lit(prefix), n.cast("string"), F.lit(" " + k.message))
        rows.append(F.struct(
            F.lit(k.column).alias("column"),
            F.lit(k.rule).alias("rule"),
            n.alias("violations"),
            F.when(n > 0, message).alias("message"),
        ))
    return counted.select(F.inline(F.array(*rows)))


def tag_violations(df: DataFrame, rules: dict[str, dict[str, Any]]) -> DataFrame:
    """Add ``_violations``: the failed checks of the row, as ``column:rule``."""
    failed = [F.when(k.broken, F.lit(f"{k.column}:{k.rule}")) for k in checks(df, rules)]
    tags = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return df.withColumn("_violations", tags)


def split_valid(
    df: DataFrame, rules: dict[str, dict[str, Any]]
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and the quarantined rest with their tags."""
    tagged = tag_violations(df, rules)
    good = tagged.where(F.size("_violations") == 0).drop("_violations")
    return good, tagged.where(F.size("_violations") > 0)
