"""Column expressions over calendar days."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.fixed import FISCAL_START


def date_key(day: Column) -> Column:
    """20240131 for 2024-01-31."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def weekday_number(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return (F.weekday(day) + 1).cast("int")


def fiscal_year(day: Column) -> Column:
    return F.when(F.month(day) >= FISCAL_START, F.year(day)).otherwise(F.year(day) - 1)


def fiscal_quarter(day: Column) -> Column:
    months_in = F.pmod(F.month(day) - FISCAL_START, F.lit(12))
    return (F.floor(months_in / 3) + 1).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    """Every attribute of the date dimension, in table order."""
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "day_of_week": F.date_format(day, "EEEE"),
        "day_of_week_num": weekday_number(day),
        "month_name": F.date_format(day, "MMMM"),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
        "is_holiday": F.lit(0),
        "fiscal_year": fiscal_year(day),
        "fiscal_quarter": fiscal_quarter(day),
    }
