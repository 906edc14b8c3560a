"""Columns inside nested schemas, and whether a cell has a value."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing(c: Column, dtype: T.DataType) -> Column:
    """Whether a cell has no value: null, or not a number where numbers are expected."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def present(c: Column, dtype: T.DataType) -> Column:
    """The cell, null where its value is missing."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(c, F.lit(None).cast(dtype))
    return c


def quoted(path: list[str]) -> str:
    return ".".join(f"`{p}`" for p in path)


def flat_columns(schema: T.StructType, root: tuple[str, ...] = ()) -> dict[str, Column]:
    """Dotted name to column, for every leaf below nested objects; arrays are leaves."""
    out = {}
    for f in schema.fields:
        here = (*root, f.name)
        if isinstance(f.dataType, T.StructType):
            out.update(flat_columns(f.dataType, here))
        else:
            out[".".join(here)] = F.col(quoted(list(here)))
    return out
