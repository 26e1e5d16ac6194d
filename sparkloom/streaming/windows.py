"""Event-time windows over streams of events (ts, event_type, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str, late: str) -> DataFrame:
    """Counts and sums per window and event type; rows later than the watermark are dropped. ts without zone is taken as the session's."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    out = timed.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")
