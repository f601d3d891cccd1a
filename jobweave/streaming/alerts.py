"""Windowed counts over time-stamped events, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOOK_BACK, EVERY = "2 hours", "1 hour"  # fixed values of the failure alert
# Weeks start on Monday 08:00 UTC; windows count from 1970-01-01, a Thursday.
WEEK, WEEK_OFFSET = "7 days", "4 days 8 hours"


def _timed(events: DataFrame, late: str | None) -> DataFrame:
    # Watermarks need a time stamp with zone.
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed if late is None else timed.withWatermark("ts", late)


def failure_windows(events: DataFrame, late: str | None = None) -> DataFrame:
    """Failures per two-hour window, every hour, for windows with any. Give `late` on a stream: the
    time a failure may arrive late."""
    failures = _timed(events.filter("event_type = 'error'"), late)
    return (
        failures.groupBy(F.window("ts", LOOK_BACK, EVERY).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_failures"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_failures")
    )


def failure_stream(events: DataFrame, target: str, checkpoint: str, late: str = "2 hours") -> StreamingQuery:
    """Write the failure windows of a stream to `target` as they change, and stop at the end of the input.

    Each micro-batch writes the windows it has changed, closed or not, into a folder of its own, so that a
    repeated batch replaces its files. `failure_state` reads what holds.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        failure_windows(events, late)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def failure_state(stored: DataFrame) -> DataFrame:
    """The last state of every window that `failure_stream` has written."""
    return stored.groupBy("window_start", "window_end").agg(F.max_by("n_failures", "batch").alias("n_failures"))


def weekly_activity(events: DataFrame, late: str | None = None) -> DataFrame:
    """Events per weekly cycle and type."""
    return (
        _timed(events, late)
        .groupBy(F.window("ts", WEEK, WEEK, WEEK_OFFSET).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(F.col("w.start").alias("week_start"), "event_type", "n_events")
    )
