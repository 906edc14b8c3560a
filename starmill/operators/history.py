"""Type 2 history: how the attributes of a key changed, and which version held on a day.

A history is kept as states, one row per key and day on which the key was seen. Its versions are intervals of days with
equal attributes; they follow from the states alone, so a change that arrives late closes, splits or joins intervals
just as if it had come in time.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_states(rows: DataFrame, key: str, day: Column, attributes: list[str], order: Column) -> DataFrame:
    """(key, day, attributes): what the last row of each day says about a key.

    Rows without a key or a day say nothing. Tasks reduce their rows to one per
    key and day before anything is shuffled.
    """
    seen = rows.select(key, day.cast("date").alias("_day"), *attributes, order.alias("_order"))
    seen = seen.where(F.col(key).isNotNull() & F.col("_day").isNotNull())
    last = F.max_by(F.struct(*attributes), "_order").alias("_last")
    return seen.groupBy(key, F.col("_day").alias("day")).agg(last).select(key, "day", "_last.*")


def merge_states(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The states after a batch, early or late: where both saw a key on a day, the batch is right."""
    known = stored.join(batch.select(key, "day"), [key, "day"], "left_anti")
    return known.unionByName(batch)


def versions(states: DataFrame, key: str) -> DataFrame:
    """(key, version, attributes, valid_from, valid_to, is_current): maximal runs of equal attributes.

    ``valid_to`` is the day the next version begins, null for the current one;
    null attributes are values like others. A key's states, which one task
    orders, are at most one for each day.
    """
    attributes = [c for c in states.columns if c not in (key, "day")]
    by_day = Window.partitionBy(key).orderBy("day")
    now = F.struct(*attributes)
    before = F.lag(now).over(by_day)
    changed = states.withColumn("_changed", before.isNull() | ~now.eqNullSafe(before)).where("_changed")
    return changed.select(
        key, F.row_number().over(by_day).cast("long").alias("version"), *attributes,
        F.col("day").alias("valid_from"), F.lead("day").over(by_day).alias("valid_to"),
    ).withColumn("is_current", F.col("valid_to").isNull())


def changed_versions(stored: DataFrame, states: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """All versions after a batch: only keys the batch names are worked out again.

    ``stored`` are the versions before, ``states`` the states after the batch.
    """
    touched = batch.select(key).distinct()
    again = versions(states.join(touched, key, "left_semi"), key)
    return stored.join(touched, key, "left_anti").unionByName(again)


def as_of(facts: DataFrame, history: DataFrame, key: str, day: str) -> DataFrame:
    """Facts with the version of their key that held on their day; null where none did.

    Versions are laid out over the months in which their key has facts at all,
    and facts meet them by key and month: at most one version a day of the month
    stands against a fact, however often its key changed or is named.
    """
    month = F.trunc(F.col(day).cast("date"), "month")
    needed = facts.select(F.col(key).alias("_key"), month.alias("_month")).where("_key IS NOT NULL AND _month IS NOT NULL").distinct()
    columns = [c for c in history.columns if c != key]
    held = history.select(F.col(key).alias("_held"), F.struct(*columns).alias("_version"), "valid_from", "valid_to")
    overlaps = (
        (F.col("_key") == F.col("_held")) & (F.col("valid_from") < F.add_months("_month", 1))
        & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_month")))
    )
    cover = needed.join(held, overlaps).select("_key", "_month", "_version")
    on = F.col(day).cast("date")
    met = (
        (F.col(key) == F.col("_key")) & (month == F.col("_month")) & (on >= F.col("_version.valid_from"))
        & (F.col("_version.valid_to").isNull() | (on < F.col("_version.valid_to")))
    )
    return facts.join(cover, met, "left").select(
        *(F.col(f"`{c}`") for c in facts.columns), *(F.col(f"_version.{c}").alias(c) for c in columns if c not in facts.columns)
    )
