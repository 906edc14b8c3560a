"""Sessions: runs of a key's events of which each follows the one before within a gap.

Events of one key that fall into one slot, a stretch of time as long as the gap, are always of one session. So events are
first added up by slot, on the side that reads them, and sessions are runs of slots: what is shuffled and sorted for a key
grows with the time it spans and not with its events, however hot it is. Streams keep slots as their state; an event that
comes late changes its slot, and sessions that it joins are read as one.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slots(events: DataFrame, key: str, time: str, value: Column, gap: int) -> DataFrame:
    """(key, period, started, ended, events, value) by slots of ``gap`` seconds, of a table or a stream.

    Times are timestamps. An event without a time is in no slot; events without a key share one.
    """
    slot = F.window(time, f"{gap} seconds")
    return (
        events.groupBy(key, slot)
        .agg(F.min(time).alias("started"), F.max(time).alias("ended"), F.count("*").alias("events"), F.sum(value).alias("value"))
        .select(key, F.col("window.start").alias("period"), "started", "ended", "events", "value")
    )


def sessions(by_slot: DataFrame, key: str, gap: int) -> DataFrame:
    """(key, started, ended, events, value): slots joined where at most ``gap`` seconds lie between their events."""
    in_order = Window.partitionBy(key).orderBy("period")
    pause = F.unix_micros("started") - F.lag(F.unix_micros("ended")).over(in_order)
    begins = F.when(pause <= gap * 1_000_000, 0).otherwise(1)
    numbered = by_slot.withColumn("begins", begins).withColumn("session", F.sum("begins").over(in_order))
    return (
        numbered.groupBy(key, "session")
        .agg(
            F.min("started").alias("started"), F.max("ended").alias("ended"), F.sum("events").alias("events"),
            F.sum("value").alias("value"),
        )
        .drop("session")
    )
