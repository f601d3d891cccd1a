"""A table in buckets against the plans over whole snapshots, and which files a change touches."""

import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from fixtures import keys
from jobweave.operators import store
from jobweave.sources.buckets import BucketedTable

SCHEMA = "source_id string, job_id string, title string, n int"
KEY = ["source_id", "job_id"]


def rows(spark, n, title, start=0):
    made = [("b" if i % 3 else f"b{i % 5}", str(i), title, i) for i in range(start, start + n)]
    return spark.createDataFrame(made, SCHEMA)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{path}/rows") for f in names if f.startswith("part")}


@pytest.fixture
def table(spark, tmp_path):
    made = BucketedTable(spark, str(tmp_path / "t"), rows(spark, 1, "").schema, KEY, buckets=32)
    made.upsert(1, rows(spark, 400, "old"), [F.desc("n")])
    return made


def test_upserts_equal_the_snapshot(spark, table):
    batch = rows(spark, 30, "new", 390).unionByName(rows(spark, 5, "newest", 392).withColumn("n", F.lit(10_000)))
    batch = batch.unionByName(spark.createDataFrame([(None, "x", "null", 1), (None, "x", "null", 2), ("b", None, "null", 3)], SCHEMA))
    whole = store.upsert(rows(spark, 400, "old"), batch, KEY, [F.desc("n")])
    table.upsert(2, batch, [F.desc("n")])
    assert sorted(map(str, table.read().collect())) == sorted(map(str, whole.collect()))
    assert table.read(before=2).count() == 400


def test_a_change_leaves_other_buckets_alone(spark, table):
    before = files(table.path)
    batch = rows(spark, 2, "new", 7)
    met = table.upsert(2, batch, [F.desc("n")])
    assert 1 <= len(met) <= 2
    after = files(table.path)
    assert all(after[f] == t for f, t in before.items())
    assert all(any(f"/bucket={b}/version=2/" in f for b in met) for f in set(after) - set(before))
    read = table.read(met, before=2).inputFiles()
    assert read and all(any(f"/bucket={b}/" in f for b in met) for f in read)
    assert table.read().count() == 400 and table.read().where("title = 'new'").count() == 2


def test_a_failed_change_is_not_seen_and_can_be_repeated(spark, table, monkeypatch):
    batch = rows(spark, 20, "new", 390)
    monkeypatch.setattr(BucketedTable, "_sizes", lambda self, paths: 1 / 0)  # dies after the rows, before the commit
    with pytest.raises(ZeroDivisionError):
        table.upsert(2, batch, [F.desc("n")])
    monkeypatch.undo()
    assert table.versions() == [1] and table.read().where("title = 'new'").count() == 0 and table.read().count() == 400
    # A version of the same number, here with fewer keys, replaces it.
    table.upsert(2, rows(spark, 3, "new", 399), [F.desc("n")])
    assert keys(table.read().where("title = 'new'"), "job_id") == {("399",), ("400",), ("401",)} and table.read().count() == 402
    table.upsert(2, rows(spark, 3, "new", 399), [F.desc("n")])
    assert table.read().count() == 402


def test_insert_mark_and_emptied_buckets(spark, table, tmp_path):
    table.insert_if_absent(2, rows(spark, 10, "new", 395), [F.col("n")])
    assert table.read().count() == 405 and table.read().where("title = 'new'").count() == 5
    table.change(3, rows(spark, 405, ""), lambda old, keys_: old.join(keys_, KEY, "left_anti"))
    assert table.read().count() == 0 and table.current() == {}
    table.upsert(4, rows(spark, 2, "back"), [F.col("n")])
    assert table.read().count() == 2
    sent = BucketedTable(spark, str(tmp_path / "e"), spark.createDataFrame([], "user_id string, email_sent boolean").schema, ["user_id"], 4)
    sent.upsert(1, spark.createDataFrame([("a", False), ("b", None)], "user_id string, email_sent boolean"), [F.col("user_id")])
    sent.mark_sent(2, spark.createDataFrame([("b",), ("unknown",)], "user_id string"))
    assert keys(sent.read(), "user_id", "email_sent") == {("a", False), ("b", True)}


def test_vacuum_keeps_what_is_read(spark, table):
    table.upsert(2, rows(spark, 400, "new"), [F.col("n")])
    assert table.vacuum() == 32 and table.read().where("title = 'new'").count() == 400 and table.vacuum() == 0


def test_another_number_of_buckets_is_refused(spark, table):
    with pytest.raises(ValueError, match="32 buckets"):
        BucketedTable(spark, table.path, table.schema, KEY, buckets=8).read()


def test_a_change_shuffles_no_row_by_key_and_again_by_bucket(spark, tmp_path, monkeypatch):
    """Stored rows and the batch go to their bucket, and from there to the files; keys to look up go there beside them."""
    plans = []
    write = DataFrameWriter.partitionBy

    def seen(writer, *columns):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, *columns)

    monkeypatch.setattr(DataFrameWriter, "partitionBy", seen)
    made = BucketedTable(spark, str(tmp_path / "e"), spark.createDataFrame([], "user_id string, email_sent boolean").schema, ["user_id"], 4)
    batch = spark.createDataFrame([("a", False), ("b", None), ("a", True), (None, None), (None, None)], "user_id string, email_sent boolean")
    made.upsert(1, batch, [F.col("email_sent")])
    made.upsert(2, batch.where("user_id = 'a'"), [F.desc("email_sent")])
    made.insert_if_absent(3, batch.where("user_id = 'b'"), [F.desc("email_sent")])
    made.mark_sent(4, batch.where("user_id = 'b' OR user_id IS NULL"))
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 3, 3, 2]
    assert keys(made.read(), "user_id", "email_sent") == {("a", True), ("b", True), (None, None)} and made.read().count() == 3
