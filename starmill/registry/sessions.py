"""Queries of sessions: a table's, and a stream's whose files each hold events of all times."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.sessions import sessions, slots
from starmill.registry.tables import MONEY, table
from starmill.streaming.ingest import publish_stream, published_totals, stream_slots
from starmill.workspace import scratch_path

GAP = 6 * 3600
VALUE = f"CAST(value AS {MONEY})"


def shown(found: DataFrame) -> DataFrame:
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("started", "ended")}
    return found.withColumns(times | {"value": F.col("value").cast("decimal(28,2)")})


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return shown(sessions(slots(events, "user_id", "ts", F.expr(VALUE), GAP), "user_id", GAP))


def late_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files in turn, each with a third of the events: later ones join sessions of the earlier."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    folder, out = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    events.repartition(3, "event_id").write.parquet(folder)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    publish_stream(
        stream_slots(arriving, "user_id", "ts", F.expr(VALUE), GAP, late="4000 days"), out, scratch_path(spark, "state")
    ).awaitTermination()
    return shown(sessions(published_totals(spark, out, "user_id", "period"), "user_id", GAP))


SESSIONS = f"""
WITH marked AS (
  SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) <= {GAP * 1_000_000}
            THEN 0 ELSE 1 END AS begins
  FROM events),
numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS n FROM marked)
SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS value
FROM numbered GROUP BY user_id, n"""

QUERIES = {
    "ses_1": (event_sessions, SESSIONS),
    "ses_1_late": (late_sessions, SESSIONS),
}
