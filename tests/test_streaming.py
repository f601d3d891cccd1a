"""Streams against the same plans over the whole input as a batch."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from fixtures import keys
from jobweave.streaming import alerts, ingest


def test_closed_failure_windows_equal_the_batch(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    source, out = str(tmp_path / "events"), str(tmp_path / "out")
    # Three files in time order, one per micro-batch.
    cuts = ["2024-01-08", "2024-01-20", "2024-03-01"]
    for i, (start, end) in enumerate(zip(["2000-01-01", *cuts], cuts)):
        events.filter(F.col("ts").between(start, F.lit(end).cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND"))).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    windows = alerts.failure_windows(stream, late="2 hours")
    query = windows.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    found = keys(spark.read.parquet(out), "window_start", "window_end", "n_failures")
    whole = keys(alerts.failure_windows(events), "window_start", "window_end", "n_failures")
    newest = events.filter("event_type = 'error'").agg(F.max("ts")).first()[0]
    closed = {row for row in whole if row[1] <= newest - datetime.timedelta(hours=2)}
    assert closed <= found <= whole and len(closed) > 100


def test_weeks_start_on_monday_morning(spark, data):
    weeks = alerts.weekly_activity(spark.read.parquet(f"{data}/events.parquet"))
    assert {(r.week_start.weekday(), r.week_start.hour) for r in weeks.collect()} == {(0, 8)}


SCHEMA = "source_id string, job_id string, title string, n int"


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w") as out:
        for source_id, job_id, title, n in rows:
            out.write(json.dumps({"source_id": source_id, "job_id": job_id, "title": title, "n": n}) + "\n")
    # Files are read in order of their time.
    os.utime(folder / name, (int(name[0]), int(name[0])))


def run(spark, folder, store, progress):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    ingest.ingest_stream(stream, str(store), str(progress), [F.col("n")]).awaitTermination()
    return spark.read.parquet(str(store))


def test_only_unseen_keys_enter_across_batches_and_runs(spark, tmp_path):
    folder, store, progress = tmp_path / "in", tmp_path / "store", tmp_path / "cp"
    put(folder, "1.json", [("a", "1", "x", 2), ("a", "1", "w", 1), ("a", "2", "x", 1)])
    assert keys(run(spark, folder, store, progress), "source_id", "job_id", "title") == {("a", "1", "w"), ("a", "2", "x")}
    put(folder, "2.json", [("a", "1", "late", 0), ("b", "1", "x", 1)])
    put(folder, "3.json", [("b", "1", "again", 0), ("a", "3", "x", 1)])
    after = run(spark, folder, store, progress)
    assert keys(after, "source_id", "job_id", "title") == {("a", "1", "w"), ("a", "2", "x"), ("b", "1", "x"), ("a", "3", "x")}


def bucket_folders(store):
    return {n for n in os.listdir(store) if n.startswith("bucket_of_")}


def test_a_batch_opens_only_its_buckets(spark, tmp_path):
    folder, store, progress = tmp_path / "in", tmp_path / "store", tmp_path / "cp"
    put(folder, "1.json", [("a", str(i), "x", 1) for i in range(600)])
    run(spark, folder, store, progress)
    column = ingest.bucket_column(ingest.BUCKETS)
    assert len(bucket_folders(store)) > 200
    one = spark.createDataFrame([("a", "77", "late", 0)], SCHEMA)
    hit = [r[0] for r in one.select(ingest.bucket_of(ingest.BUCKETS)).collect()]
    known = ingest.stored_keys(spark, str(store), one.schema, 1, hit)
    assert ("a", "77") in keys(known, "source_id", "job_id")
    assert known.inputFiles() and all(f"/{column}={hit[0]}/" in f for f in known.inputFiles())
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source_id:string,job_id:string>" in plan
    # Other buckets may be gone, as far as this batch is concerned; only its own files are opened or written.
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(store) for f in names}
    put(folder, "2.json", [("a", "77", "late", 0), ("new", "1", "x", 0)])
    run(spark, folder, store, progress)
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(store) for f in names if f.startswith("part")}
    assert all(after[f] == t for f, t in before.items() if f.startswith("part")) and len(set(after) - set(before)) == 1


def test_no_bucket_no_reading(spark, tmp_path):
    assert ingest.stored_keys(spark, str(tmp_path / "none"), spark.createDataFrame([], SCHEMA).schema, 3, [1, 2]).collect() == []


def test_another_layout_is_refused(spark, tmp_path):
    store = tmp_path / "store"
    put(tmp_path / "in", "1.json", [("a", "1", "x", 1)])
    run(spark, tmp_path / "in", store, tmp_path / "cp")
    with pytest.raises(ValueError, match="bucket_of_7"):
        ingest.stored_keys(spark, str(store), spark.createDataFrame([], SCHEMA).schema, 1, [0], buckets=7)


def test_a_failed_batch_is_made_good(spark, tmp_path):
    """A batch that died after some of its buckets were written gives the same rows when it is repeated."""
    folder, store = tmp_path / "in", tmp_path / "store"
    put(folder, "1.json", [("a", str(i), "x", 1) for i in range(50)])
    first = sorted(run(spark, folder, store, tmp_path / "cp1").collect())
    for name in sorted(bucket_folders(store))[::2]:
        os.rename(store / name, tmp_path / name)
    assert sorted(run(spark, folder, store, tmp_path / "cp2").collect()) == first


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """Without its progress folder a stream starts again at batch 0 and gives the same store."""
    folder, store = tmp_path / "in", tmp_path / "store"
    put(folder, "1.json", [("a", "1", "x", 1), ("a", "2", "x", 1)])
    first = sorted(run(spark, folder, store, tmp_path / "cp1").collect())
    assert sorted(run(spark, folder, store, tmp_path / "cp2").collect()) == first


def test_bounded_memory_variant(spark, data, tmp_path):
    lines = spark.readStream.schema(spark.read.parquet(f"{data}/lineitem.parquet").schema).option("pathGlobFilter", "lineitem.parquet").parquet(data)
    records = lines.select(F.lit("b").alias("source_id"), F.col("l_partkey").cast("string").alias("job_id"), F.col("l_shipdate").cast("timestamp").alias("seen_at"))
    out = str(tmp_path / "out")
    query = ingest.deduplicated(records, "seen_at", "3650 days").writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == stored.distinct().count() == spark.read.parquet(f"{data}/lineitem.parquet").select("l_partkey").distinct().count()
