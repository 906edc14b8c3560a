"""Sessions of a table and of a stream."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from starmill.operators.sessions import sessions, slots
from starmill.streaming.ingest import publish_stream, published_totals, stream_slots

SCHEMA = "who string, at timestamp, value long"
NOON = datetime(2024, 1, 1, 12)


def rows(*found):
    return [(who, None if second is None else NOON + timedelta(seconds=second), 1) for who, second in found]


def shown(df):
    def seconds(at):
        return round((at - NOON).total_seconds(), 6)

    return sorted(
        (r["who"] or "", seconds(r["started"]), seconds(r["ended"]), r["events"], r["value"]) for r in df.collect()
    )


def test_a_gap_is_the_longest_pause_within_a_session(spark):
    events = spark.createDataFrame(
        rows(("a", 0), ("a", 60), ("a", 120.000001), ("a", 120.000001), ("b", 59), ("b", 119), ("b", 179), (None, 5), ("a", None)),
        SCHEMA,
    )
    found = sessions(slots(events, "who", "at", F.col("value"), 60), "who", 60)
    assert shown(found) == [("", 5, 5, 1, 1), ("a", 0, 60, 2, 2), ("a", 120.000001, 120.000001, 2, 2), ("b", 59, 179, 3, 3)]
    assert shown(sessions(slots(events.limit(0), "who", "at", F.col("value"), 60), "who", 60)) == []


def test_raw_events_are_added_up_before_they_are_shuffled(spark):
    events = spark.createDataFrame(rows(("a", 0)), SCHEMA)
    plan = sessions(slots(events, "who", "at", F.col("value"), 60), "who", 60)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in below and "Sort" not in below


def test_a_late_event_joins_two_sessions(spark, tmp_path):
    folder, out, state = (f"file:{tmp_path}/{name}" for name in ("in", "out", "state"))

    def arrive(*found):
        spark.createDataFrame(rows(*found), SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        by_slot = stream_slots(stream, "who", "at", F.col("value"), 60, late="10 minutes")
        publish_stream(by_slot, out, state).awaitTermination()
        return shown(sessions(published_totals(spark, out, "who", "period"), "who", 60))

    assert arrive(("a", 0), ("a", 100)) == [("a", 0, 0, 1, 1), ("a", 100, 100, 1, 1)]
    assert arrive(("a", 50)) == [("a", 0, 100, 3, 3)]
    assert arrive(("b", 7200)) == [("a", 0, 100, 3, 3), ("b", 7200, 7200, 1, 1)]
    # Too late: the state of its slot is gone.
    assert arrive(("a", 20)) == [("a", 0, 100, 3, 3), ("b", 7200, 7200, 1, 1)]
