"""The alert rule: stored events, streams in many parts and late events give the same transitions."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import keys
from jobweave.streaming import rule

START = dt.datetime(2024, 3, 1)
COLUMNS = ("key", "state", "at", "since", "n_failures")
SCHEMA = "user_id string, event_type string, ts timestamp_ntz"


def log(seed=1, n=400):
    rng = random.Random(seed)
    rows = [(f"u{rng.randrange(6)}", rng.choice(["error", "view", "view"]), START + dt.timedelta(minutes=rng.randrange(0, 6000))) for _ in range(n)]
    rows += [("edge", "error", START + dt.timedelta(hours=5)), ("edge", "error", START + dt.timedelta(hours=8) - dt.timedelta(microseconds=1))]
    rows += [("calm", "view", START), (None, "error", START + dt.timedelta(hours=1, minutes=3)), ("u0", None, START)]
    return sorted(rows, key=lambda r: r[2])


def by_hand(rows, threshold=0):
    until = max(r[2] for r in rows) - dt.timedelta(hours=2)
    found = set()
    for key in {r[0] for r in rows}:
        times = [r[2] for r in rows if r[0] == key and r[1] == "error"]
        at, since = START - dt.timedelta(hours=1), None
        while at <= until:
            n = sum(at - dt.timedelta(hours=2) <= t < at for t in times)
            if n > threshold and since is None:
                since = at
                found.add((key, "fired", at, since, n))
            elif n <= threshold and since is not None:
                found.add((key, "resolved", at, since, n))
                since = None
            at += dt.timedelta(hours=1)
    return found


@pytest.mark.parametrize("threshold", [0, 1])
def test_stored_events_against_an_hourly_evaluation(spark, threshold):
    rows = log()
    events = spark.createDataFrame(rows, SCHEMA)
    until = F.lit(max(r[2] for r in rows) - dt.timedelta(hours=2))
    assert keys(rule.transitions(events, "user_id", until, threshold), *COLUMNS) == by_hand(rows, threshold)


def run(spark, parts, folder, threshold=0, per_file=True):
    """Feed `parts` as files, in one run of many batches or in a run for each part."""
    source, target, progress = (str(folder / n) for n in ("in", "out", "cp"))
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        new = [os.path.join(source, f) for f in os.listdir(source) if f.endswith(".parquet")]
        for f in new:
            if os.stat(f).st_mtime > 10_000:
                os.utime(f, (100 + i, 100 + i))
        if not per_file:
            stream = spark.readStream.schema(SCHEMA).parquet(source)
            rule.transition_stream(stream, "user_id", target, progress, threshold=threshold).awaitTermination()
    if per_file:
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        rule.transition_stream(stream, "user_id", target, progress, threshold=threshold).awaitTermination()
    return spark.read.parquet(target)


@pytest.mark.parametrize("n_parts, per_file", [(1, True), (9, True), (4, False)])
def test_streams_in_parts_and_late_events(spark, tmp_path, n_parts, per_file):
    rows = log(2, 250)
    rng = random.Random(5)
    # An event may come up to 100 minutes after later ones.
    arrival = sorted(rows, key=lambda r: (r[2] + dt.timedelta(minutes=rng.randrange(0, 100))))
    size = -(-len(arrival) // n_parts)
    parts = [arrival[i : i + size] for i in range(0, len(arrival), size)]
    found = run(spark, parts, tmp_path, per_file=per_file)
    assert keys(found, *COLUMNS) == by_hand(rows) and found.count() == len(by_hand(rows))


def test_an_alert_is_told_before_it_resolves(spark, tmp_path):
    first = [("a", "error", START + dt.timedelta(minutes=10)), ("a", "view", START + dt.timedelta(hours=3, minutes=30))]
    fired = ("a", "fired", START + dt.timedelta(hours=1), START + dt.timedelta(hours=1), 1)
    found = run(spark, [first], tmp_path, per_file=False)
    assert keys(found, *COLUMNS) == {fired}
    assert keys(rule.open_alerts(found), "key", "since", "n_failures") == {("a", START + dt.timedelta(hours=1), 1)}
    late = [("a", "error", START + dt.timedelta(minutes=20)), ("a", "view", START + dt.timedelta(hours=9))]  # beyond the watermark: as if it were not there
    found = run(spark, [late], tmp_path, per_file=False)
    resolved = ("a", "resolved", START + dt.timedelta(hours=3), START + dt.timedelta(hours=1), 0)
    assert keys(found, *COLUMNS) == {fired, resolved}
    assert rule.open_alerts(found).count() == 0


def test_evaluate_forgets_nothing_between_calls():
    rng = random.Random(7)
    for _ in range(200):
        counts = {rng.randrange(40): rng.randrange(1, 3) for _ in range(rng.randrange(8))}
        whole, _ = rule.evaluate(counts, None, -1, 60, 1)
        found, since, evaluated = [], None, -1
        for due in sorted(rng.sample(range(60), 6)) + [60]:
            more, since = rule.evaluate(counts, since, evaluated, due, 1)
            found, evaluated = found + more, due
        assert found == whole


def test_failures_of_a_key_add_up_by_hour():
    counts = {7: 2}
    rule.add_hours(counts, np.array([9, 7, 9, -1], np.int64))
    assert counts == {7: 3, 9: 2, -1: 1} and all(type(h) is int for h in counts)
    rule.add_hours(counts, np.array([], np.int64))
    assert counts == {7: 3, 9: 2, -1: 1}
