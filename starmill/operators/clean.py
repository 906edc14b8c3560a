"""Cleaning: names, white space, nulls, fills and types, as plain projections.

Columns whose name starts with an underscore carry lineage and order; no
cleaning step reads or changes them.
"""

import logging
from dataclasses import dataclass, field
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions import text
from starmill.functions.columns import missing, present
from starmill.functions.fixed import NULL_TOKENS, UNKNOWN
from starmill.operators.numbering import exact_medians

log = logging.getLogger(__name__)

INT_HINTS = ("int", "int64")
FLOAT_HINTS = ("float", "float64")

# Other type names a type map may use, and the Spark type each casts to.
PLAIN_HINTS = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "float32": "float",
    "str": "string", "string": "string",
}


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def drop_metadata(df: DataFrame) -> DataFrame:
    return df.select(*data_columns(df))


def _replaced(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return df.select(*[
        changes[c].alias(c) if c in changes else F.col(c) for c in df.columns
    ])


def _string_columns(df: DataFrame) -> list[str]:
    return [c for c in data_columns(df) if isinstance(df.schema[c].dataType, T.StringType)]


def standardize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*text.standard_names(df.columns))


def strip_strings(df: DataFrame) -> DataFrame:
    return _replaced(df, {c: text.stripped(F.col(c)) for c in _string_columns(df)})


def null_tokens(df: DataFrame, tokens: list[Any] = NULL_TOKENS) -> DataFrame:
    """Null for a cell that equals one of the tokens as a whole.

    Words are compared with strings, numbers with numbers; a None among the
    tokens, which is what is replaced by anyway, changes nothing.
    """
    words = [t for t in tokens if isinstance(t, str)]
    numbers = [t for t in tokens if isinstance(t, (int, float)) and not isinstance(t, bool)]
    changes = {c: F.when(~F.col(c).isin(*words), F.col(c)) for c in _string_columns(df) if words}
    for c in data_columns(df):
        if numbers and isinstance(df.schema[c].dataType, T.NumericType):
            equal = reduce(or_, [F.col(c) == F.lit(t) for t in numbers])
            changes[c] = F.when(~equal, F.col(c))
    return _replaced(df, changes)


def _present(df: DataFrame, c: str) -> Column:
    return ~missing(F.col(c), df.schema[c].dataType)


def _known(df: DataFrame, c: str) -> Column:
    return present(F.col(c), df.schema[c].dataType)


def drop_null_rows(df: DataFrame) -> DataFrame:
    for c in data_columns(df):
        df = df.where(_present(df, c))
    return df


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose data columns are all null."""
    columns = data_columns(df)
    if not columns or not all(df.schema[c].nullable for c in columns):
        return df  # some column always has a value
    some = reduce(or_, [_present(df, c) for c in columns])
    # One condition over every column makes the optimizer derive a constraint for
    # each subset of them; a condition it takes for non-deterministic does not.
    return df.where(F.when(F.spark_partition_id() >= 0, some))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of missing values in each data column."""
    return df.agg(*[F.count_if(~_present(df, c)).alias(c) for c in data_columns(df)])


def fill_given(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Replace nulls by the value given for the column, in a type that holds both."""
    changes = {}
    for c, value in values.items():
        if c not in df.columns or value is None:
            continue
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.StringType):
            fill = F.lit(str(value))
        elif isinstance(dtype, T.IntegralType) and isinstance(value, float):
            changes[c] = F.coalesce(F.col(c).cast("double"), F.lit(value))
            continue
        else:
            fill = F.lit(value)
        changes[c] = F.coalesce(_known(df, c), fill)
    return _replaced(df, changes)


@dataclass
class ColumnFacts:
    """What filling and casting must know about whole columns."""

    has_null: set[str] = field(default_factory=set)
    mean: dict[str, float] = field(default_factory=dict)
    median: dict[str, int] = field(default_factory=dict)
    not_integer: set[str] = field(default_factory=set)
    plain_integer: set[str] = field(default_factory=set)
    plain_cast: set[str] = field(default_factory=set)
    not_castable: set[str] = field(default_factory=set)
    pattern: dict[str, str | None] = field(default_factory=dict)


def known_pattern(column: str, first: str | None) -> str | None:
    """The pattern of a column's first date; says so if its shape is not known."""
    pattern = text.date_pattern(first)
    if first is not None and pattern is None:
        log.warning(
            "dates of column %s look like %r, which no known format reads; "
            "name it in datetime_formats, or all but ISO dates become null", column, first,
        )
    return pattern


def column_facts(df: DataFrame, config: dict[str, Any]) -> ColumnFacts:
    """Gather the facts the type map and the fill strategy need, in one aggregate.

    Medians take a second, narrow pass, only for integer columns with nulls.
    """
    hints = {c: str(t).lower() for c, t in config.get("type_map", {}).items() if c in df.columns}
    filling = config.get("null_strategy", "report") == "fill"
    patterns = config.get("datetime_formats", {})
    facts = ColumnFacts(pattern=dict(patterns))
    measures: list[Column] = []

    for c in data_columns(df):
        dtype, hint = df.schema[c].dataType, hints.get(c, "")
        value = text.number(F.col(c), dtype)
        if filling and (hint or isinstance(dtype, T.NumericType)):
            measures.append(F.count_if(~_present(df, c)).alias(f"null {c}"))
        if filling and (hint in FLOAT_HINTS or isinstance(dtype, T.NumericType)):
            measures.append(F.avg(value).cast("double").alias(f"mean {c}"))
        if hint in INT_HINTS + FLOAT_HINTS and isinstance(dtype, T.StringType):
            simple = F.col(c).try_cast("long" if hint in INT_HINTS else "double")
            measures.append(F.count_if(~simple.eqNullSafe(value)).alias(f"odd {c}"))
        if hint in INT_HINTS:
            out_of_range = text.integer(F.col(c), dtype).isNull()
            measures.append(
                F.count_if(value.isNotNull() & (out_of_range | (value != F.floor(value))))
                .alias(f"broken {c}")
            )
        elif hint in FLOAT_HINTS:
            plain = F.coalesce(F.col(c).cast("string").rlike(text.INTEGER), F.lit(False))
            measures.append(F.count_if(~plain).alias(f"fraction {c}"))
        elif hint == "datetime" and c not in patterns and "_ord" in df.columns:
            if isinstance(dtype, T.StringType):
                first = F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_ord")))
                measures.append(first.alias(f"first {c}"))
        elif hint in PLAIN_HINTS:
            cast = F.col(c).try_cast(PLAIN_HINTS[hint])
            measures.append(F.count_if(F.col(c).isNotNull() & cast.isNull()).alias(f"stuck {c}"))
    if not measures:
        return facts

    row = df.agg(*measures).first().asDict()
    for name, value in row.items():
        kind, c = name.split(" ", 1)
        if kind == "null" and value:
            facts.has_null.add(c)
        elif kind == "mean" and value is not None:
            facts.mean[c] = value
        elif kind == "broken" and value:
            facts.not_integer.add(c)
        elif kind == "fraction" and not value:
            facts.plain_integer.add(c)
        elif kind == "odd" and not value:
            facts.plain_cast.add(c)
        elif kind == "stuck" and value:
            facts.not_castable.add(c)
        elif kind == "first":
            facts.pattern[c] = known_pattern(c, value)

    wanted = {
        c: text.number(F.col(c), df.schema[c].dataType)
        for c in facts.has_null if hints.get(c) in INT_HINTS
    }
    if wanted:
        medians = exact_medians(df, wanted)
        facts.median = {c: round(medians.get(c, 0)) for c in wanted}
    return facts


def fill_missing(df: DataFrame, config: dict[str, Any], facts: ColumnFacts) -> DataFrame:
    """Fill what the given values left: median, mean or a word, by hint and type."""
    hints = {c: str(t).lower() for c, t in config.get("type_map", {}).items()}
    changes = {}
    for c in data_columns(df):
        dtype, hint = df.schema[c].dataType, hints.get(c, "")
        known = _known(df, c)
        if hint in INT_HINTS:
            if c in facts.has_null:
                fill = F.lit(facts.median.get(c, 0)).cast(dtype)
                changes[c] = F.coalesce(known, fill)
        elif hint in FLOAT_HINTS or (hint != "datetime" and isinstance(dtype, T.NumericType)):
            if c in facts.has_null:
                mean = facts.mean.get(c, 0.0 if hint else None)
                if isinstance(dtype, T.StringType):
                    changes[c] = F.coalesce(known, F.lit(repr(mean)))
                else:
                    changes[c] = F.coalesce(known.cast("double"), F.lit(mean))
        elif hint != "datetime" and isinstance(dtype, T.StringType):
            changes[c] = F.coalesce(known, F.lit(UNKNOWN))
    return _replaced(df, changes)


def cast_types(
    df: DataFrame, config: dict[str, Any], facts: ColumnFacts, other_data: bool = False
) -> DataFrame:
    """Cast by the type map; what cannot be read in the new type becomes null.

    An int column that holds a fraction keeps its old type as a whole. A float
    column becomes double, or long where ``integral_floats`` is "long" and every
    cell is a plain integer. A column whose every cell Spark's own cast reads as
    we do is cast plainly; not so if the facts come from ``other_data``.
    """
    changes = {}
    plain = set() if other_data else facts.plain_cast
    for c, hint in config.get("type_map", {}).items():
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        if hint in INT_HINTS:
            if c in plain:
                changes[c] = F.col(c).try_cast("long")
            elif c not in facts.not_integer:
                changes[c] = text.integer(F.col(c), dtype)
        elif hint in FLOAT_HINTS:
            whole = c in facts.plain_integer and c not in facts.has_null
            if whole and config.get("integral_floats") == "long":
                changes[c] = text.integer(F.col(c), dtype)
            elif c in plain:
                changes[c] = F.col(c).try_cast("double")
            else:
                changes[c] = text.number(F.col(c), dtype).cast("double")
        elif hint == "datetime":
            changes[c] = text.moment(F.col(c), dtype, facts.pattern.get(c))
        elif hint == "bool":
            changes[c] = text.boolean(F.col(c), dtype)
        elif hint in PLAIN_HINTS and c not in facts.not_castable:
            changes[c] = F.col(c).try_cast(PLAIN_HINTS[hint])
    return _replaced(df, changes)


def before_facts(df: DataFrame, config: dict[str, Any]) -> DataFrame:
    """The steps that need no facts: names, white space, null tokens, given fills or drops."""
    out = df.transform(standardize_names).transform(strip_strings)
    out = null_tokens(out, config.get("null_values", NULL_TOKENS))
    strategy = config.get("null_strategy", "report")
    if strategy == "drop_rows":
        return drop_null_rows(out)
    if strategy == "fill":
        return fill_given(out, config.get("fill_values", {}))
    return out


def clean(
    df: DataFrame, config: dict[str, Any] | None = None, facts: ColumnFacts | None = None
) -> DataFrame:
    """All cleaning steps in order.

    Pass ``facts`` to reuse what an earlier batch learned; a stream has to.
    """
    config = config or {}
    out = before_facts(df, config)
    other_data = facts is not None
    if facts is None:
        facts = column_facts(out, config)
    if config.get("null_strategy", "report") == "fill":
        out = fill_missing(out, config, facts)
    return cast_types(out, config, facts, other_data).transform(drop_empty_rows)
