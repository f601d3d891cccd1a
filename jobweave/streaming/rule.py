"""The failure alert as a rule: every hour it looks two hours back and fires, keeps firing, or resolves.

An evaluation at the full hour t counts the failures of a key in [t - 2 h, t). It fires if there are more than
`threshold` and the evaluation before did not, and resolves at the first evaluation with no more than that. On a
stream an evaluation takes place once the watermark has reached it, so a failure that is late, but no more than
the watermark allows, counts in all evaluations it belongs to; the transitions do not depend on how the stream is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

HOURS_BACK = 2  # fixed value of the failure alert; it is evaluated every hour
HOUR_MS = 3_600_000
FIRED, RESOLVED = "fired", "resolved"


def _hour(ts: Column) -> Column:
    """Full hours since 1970."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / (HOUR_MS * 1000)).cast("long")


def _time(hour: str) -> Column:
    return F.timestamp_seconds(F.col(hour) * 3600)


def _described(transitions: DataFrame) -> DataFrame:
    """key, state, at, since (when the alert fired) and n_failures (those the evaluation counted)."""
    return transitions.select("key", "state", _time("at").alias("at"), _time("since").alias("since"), "n_failures")


def transitions(events: DataFrame, key: str, until: Column, threshold: int = 0) -> DataFrame:
    """All transitions of the evaluations up to `until`, from stored events.

    Failures are counted by key and hour before anything else, so a key has a row for each hour with failures.
    """
    hours = events.where("event_type = 'error'").groupBy(F.col(key).cast("string").alias("key"), _hour(F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    # The hour after the last one that counts a failure is evaluated too: it resolves the alert.
    marks = hours.select("key", F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(HOURS_BACK + 1)), lambda i: F.col("hour") + i)).alias("after", "at"), "n")
    counted = F.sum(F.when(F.col("after") < HOURS_BACK, F.col("n")).otherwise(0))
    marks = marks.groupBy("key", "at").agg(counted.alias("n_failures")).where(_time("at") <= until)
    firing = F.col("n_failures") > threshold
    ordered = Window.partitionBy("key").orderBy("at")
    # Hours that are not listed count nothing, so an alert never lasts over a gap.
    was = F.coalesce(F.lag(firing).over(ordered), F.lit(False))
    state = F.when(firing & ~was, FIRED).when(~firing & was, RESOLVED)
    changed = marks.withColumn("state", state).where("state IS NOT NULL")
    since = F.max(F.when(F.col("state") == FIRED, F.col("at"))).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return _described(changed.withColumn("since", since))


STATE = "hours array<long>, counts array<long>, since long, evaluated long"
OUTPUT = "key string, state string, at long, since long, n_failures long"


def evaluate(counts: dict[int, int], since: int | None, evaluated: int, due: int, threshold: int = 0) -> tuple[list[tuple], int | None]:
    """Transitions (state, at, since, n) of the evaluations after `evaluated` up to `due`, and since when the
    alert fires in the end (None: it doesn't). Between the hours that a failure is counted in, nothing changes."""
    found = []
    for at in sorted({h + i for h in counts for i in range(1, HOURS_BACK + 2)}):
        if not evaluated < at <= due:
            continue
        n = sum(counts.get(at - i, 0) for i in range(1, HOURS_BACK + 1))
        if n > threshold and since is None:
            since = at
            found.append((FIRED, at, since, n))
        elif n <= threshold and since is not None:
            found.append((RESOLVED, at, since, n))
            since = None
    return found, since


def add_hours(counts: dict[int, int], hours: np.ndarray) -> None:
    """Count one failure more for each of `hours`. A key has few in a batch: a pass over plain numbers is all it costs."""
    for hour in hours.tolist():
        counts[hour] = counts.get(hour, 0) + 1


def transition_rows(events: DataFrame, key: str, late: str, threshold: int = 0) -> DataFrame:
    """Transitions of a stream of events, each as soon as the watermark has reached its evaluation.

    The state of a key is the failures by hour that coming evaluations can count, and since when it fires; a key
    without either has none. All events move the watermark, failures or not.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    # The condition names `ts`, so that the filter stays above the watermark.
    failed = timed.where(F.when(F.col("event_type") == "error", F.col("ts")).isNotNull())
    rows = failed.select(F.col(key).cast("string").alias("key"), _hour(F.col("ts")).alias("hour"), "ts")

    def follow(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        hours, numbers, since, evaluated = state.get if state.exists else ([], [], None, -1)
        counts = dict(zip(hours, numbers))
        for frame in frames:
            add_hours(counts, frame["hour"].to_numpy())
        due = state.getCurrentWatermarkMs() // HOUR_MS
        found, since = evaluate(counts, since, evaluated, due, threshold)
        counts = {h: n for h, n in counts.items() if h + HOURS_BACK + 1 > due}
        if counts:
            state.update((list(counts), list(counts.values()), since, int(due)))
            state.setTimeoutTimestamp(max(min(h for h in counts) + 1, due + 1) * HOUR_MS)
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame([(group[0], *row) for row in found], columns=["key", "state", "at", "since", "n_failures"])

    return rows.groupBy("key").applyInPandasWithState(follow, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def transition_stream(events: DataFrame, key: str, target: str, checkpoint: str, late: str = "2 hours", threshold: int = 0) -> StreamingQuery:
    """Write the transitions of a stream to `target` and stop at the end of the input.

    A micro-batch writes a folder of its own, so that a repeated one replaces its files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _described(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        transition_rows(events, key, late, threshold)
        .writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def open_alerts(found: DataFrame) -> DataFrame:
    """Keys whose last transition fired: key, since and n_failures."""
    last = F.max_by(F.struct("state", "since", "n_failures"), "at").alias("last")
    return found.groupBy("key").agg(last).where(F.col("last.state") == FIRED).select("key", "last.since", "last.n_failures")
