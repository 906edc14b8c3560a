"""Column expressions over text: names, numbers and dates in text, text of a value."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.fixed import WHITESPACE

INTEGER = r"^[+-]?[0-9]+$"
# Numbers in text, in two shapes: those no double overflows on, and all.
SAFE_NUMBER = (
    r"^\s*[+-]?(([0-9]{1,200}[.]?[0-9]*|[.][0-9]+)([eE]([+]?[0-9]{1,2}|-[0-9]+))?"
    r"|(?i:inf(inity)?))\s*$"
)
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Date formats recognised in the first value of a column: shape, then Spark pattern.
DATE_SHAPES = [
    (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"),
    (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
    (r"\d{8}", "yyyyMMdd"),
    (r"(0?[1-9]|1[0-2])/\d{1,2}/\d{4}", "M/d/yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"),
    (r"(0?[1-9]|1[0-2])-\d{1,2}-\d{4}", "M-d-yyyy"),
    (r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"),
    (r"\d{1,2} [A-Z][a-z]{2} \d{4}", "d MMM yyyy"),
    (r"[A-Z][a-z]{2} \d{1,2}, \d{4}", "MMM d, yyyy"),
    (r"\d{1,2}-[A-Z][a-z]{2}-\d{4}", "d-MMM-yyyy"),
    (r"\d{1,2} [A-Z][a-z]{3,8} \d{4}", "d MMMM yyyy"),
    (r"[A-Z][a-z]{3,8} \d{1,2}, \d{4}", "MMMM d, yyyy"),
]
TIME_SHAPES = [
    (r" \d{1,2}:\d{2}", " H:mm"),
    (r" \d{1,2}:\d{2}:\d{2}", " H:mm:ss"),
    (r" \d{1,2}:\d{2}:\d{2}\.\d{1,6}", " H:mm:ss.[SSSSSS][SSS]"),
    (r"T\d{1,2}:\d{2}:\d{2}", "'T'H:mm:ss"),
    (r"T\d{1,2}:\d{2}:\d{2}\.\d{1,6}", "'T'H:mm:ss.[SSSSSS][SSS]"),
    (r" \d{1,2}:\d{2} [AP]M", " h:mm a"),
    (r" \d{1,2}:\d{2}:\d{2} [AP]M", " h:mm:ss a"),
]
# A zone after the clock. The clock is kept as it was written, so the zone is only taken off.
ZONE = r"(Z|[+-]\d{2}:?\d{2})$"
ZONED = "[zone]"


def standard_names(names: list[str]) -> list[str]:
    """Lower-cased, underscored column names; a repeated name gets a numeric suffix."""
    out: list[str] = []
    for name in names:
        base = re.sub(r"\W", "_", re.sub(r"\s+", "_", name.strip().lower()))
        unique, n = base, 2
        while unique in out:
            unique, n = f"{base}_{n}", n + 1
        out.append(unique)
    return out


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def number(c: Column, dtype: T.DataType) -> Column:
    """The numeric value of a column, null where there is none.

    Numeric columns keep their type, so integers and decimals compare exactly.
    """
    if isinstance(dtype, T.NumericType):
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return F.nanvl(c, F.lit(None).cast("double"))
        return c
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    if isinstance(dtype, T.StringType):
        d = c.try_cast("double")
        return F.when(c.rlike(SAFE_NUMBER), d).when(
            c.rlike(NUMBER), F.nullif(F.nullif(d, F.lit(float("inf"))), F.lit(float("-inf")))
        )
    return F.lit(None).cast("double")


def integer(c: Column, dtype: T.DataType) -> Column:
    """The value as a long; text of plain digits converts without passing through double."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(c.try_cast("long"), number(c, dtype).try_cast("long"))
    return number(c, dtype).try_cast("long")


def boolean(c: Column, dtype: T.DataType) -> Column:
    """True / False / 1 / 0 as text; every other value is null."""
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("boolean")
    return F.when(c.isin("True", "1"), True).when(c.isin("False", "0"), False)


def date_pattern(first: str | None) -> str | None:
    """The Spark pattern of a date text, or None if its shape is not known."""
    for shape, pattern in DATE_SHAPES:
        for tail, clock in [("", ""), *TIME_SHAPES]:
            if first is not None and re.fullmatch(shape + tail, first):
                return pattern + clock
            if first is not None and clock and re.fullmatch(shape + tail + ZONE, first):
                return pattern + clock + ZONED
    return None


def moment(c: Column, dtype: T.DataType, pattern: str | None) -> Column:
    """Text as a timestamp without zone; text that does not fit the pattern is null.

    Without a pattern the two ISO forms are accepted.
    """
    if not isinstance(dtype, T.StringType):
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("timestamp_ntz")
        return F.lit(None).cast("timestamp_ntz")
    if pattern is None:
        return F.coalesce(moment(c, dtype, "yyyy-M-d"), moment(c, dtype, "yyyy-M-d H:mm:ss"))
    if pattern.endswith(ZONED):
        bare = F.when(c.rlike(ZONE), F.regexp_replace(c, ZONE, ""))
        return moment(bare, dtype, pattern.removesuffix(ZONED))
    if "H" in pattern or "h" in pattern:
        return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
    return F.try_to_date(c, pattern).cast("timestamp_ntz")


def day(c: Column, dtype: T.DataType, pattern: str | None = None) -> Column:
    """The calendar day of a date, timestamp or text column; null where it is none.

    Text is read by the pattern, or as one of the two ISO forms without one.
    """
    if isinstance(dtype, T.StringType):
        return moment(c, dtype, pattern).cast("date")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    return F.lit(None).cast("date")


def double_text(c: Column) -> Column:
    """Shortest text of a double: plain from 1e-4 up to 1e16, otherwise like 1e-05 or 1e+16."""
    java = c.cast("string")
    digits = java.try_cast("decimal(38,21)").cast("string")
    scientific = F.regexp_replace(java, r"(\.0)?E(\d+)$", "e+$2")
    scientific = F.regexp_replace(scientific, r"(\.0)?E-(\d)$", "e-0$2")
    scientific = F.regexp_replace(scientific, r"(\.0)?E-(\d+)$", "e-$2")
    return (
        F.when(F.isnan(c), "nan")
        .when(~F.contains(java, F.lit("E")), F.replace(java, F.lit("Infinity"), F.lit("inf")))
        .when(F.abs(c).between(1e-4, 9999999999999998.0), F.regexp_replace(digits, r"(\.\d+?)0+$", "$1"))
        .otherwise(scientific)
    )


def value_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a value as rules and fingerprints see it; null stays null."""
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return double_text(c.cast("double"))
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz").cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        fraction = F.date_format(c, "SSSSSS")
        return F.concat(
            F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
            F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)),
        )
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def row_digest(columns: dict[str, T.DataType]) -> Column:
    """32 bytes that differ for rows that differ in any column; nulls equal each other.

    Every cell goes in with its length, so no two rows spell the same text.
    """
    cells = []
    for name, dtype in columns.items():
        c = F.col(f"`{name}`")
        if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
            word = F.to_json(c, {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
        elif isinstance(dtype, (T.DoubleType, T.FloatType)):
            word = (c + F.lit(0.0)).cast("string")  # one zero, not two
        else:
            word = c.cast("string")
        cells.append(F.coalesce(F.concat(F.length(word).cast("string"), F.lit(":"), word), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*cells), 256))


def null_text(dtype: T.DataType) -> str:
    """Text that stands for null in a row fingerprint."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "NaT"
    if isinstance(dtype, T.IntegralType):
        return "<NA>"
    return "nan"
