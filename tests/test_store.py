import pytest
from pyspark.sql import functions as F

from fixtures import evaluations, keys, postings, users
from jobweave import schemas
from jobweave.operators import report, store, worklist
from jobweave.sources import tables


def newest():
    return [F.desc("evaluated_at"), F.desc("score")]


def test_insert_keeps_stored_rows_and_the_first_of_a_batch(spark):
    batch = [("P-17", "board", "changed", "", "", "", "", "", "1"), ("P-52", "board", "first", "", "", "", "", "", "1"), ("P-52", "board", "second", "", "", "", "", "", "2")]
    added = store.insert_if_absent(postings(spark), postings(spark, batch), store.POSTING_KEY, [F.col("scraped_at")])
    assert keys(added, "job_id", "title") == {("P-52", "first")}


def test_upsert_replaces_and_is_idempotent(spark):
    old = evaluations(spark, [("a", "1", 3, True), ("a", "2", 4, False)])
    batch = evaluations(spark, [("a", "1", 9, False), ("a", "1", 8, False), ("b", "1", 5, False)])
    once = store.upsert(old, batch, store.EVALUATION_KEY, newest())
    twice = store.upsert(once, batch, store.EVALUATION_KEY, newest())
    assert keys(once, "user_id", "job_id", "score") == {("a", "1", 9), ("a", "2", 4), ("b", "1", 5)}
    assert sorted(once.collect()) == sorted(twice.collect())


def test_mark_sent_skips_unknown_keys(spark):
    done = evaluations(spark, [("a", "1", 3, False), ("a", "2", 4, None)])
    sent = evaluations(spark, [("a", "2", 4, None), ("a", "2", 4, None), ("z", "9", 1, None)])
    assert keys(store.mark_sent(done, sent), "job_id", "email_sent") == {("1", False), ("2", True)}


def test_reset_keeps_nothing_and_reports_the_count(spark):
    done = evaluations(spark, [("a", "1", 3, False), ("a", "2", 4, None)])
    assert store.cleared(done).isEmpty() and store.cleared(done).schema == done.schema
    assert store.cleared_count(done).first().n_cleared == 2


def test_user_ids_fall_back(spark):
    rows = spark.createDataFrame([("i", "u", "m"), (None, "u", "m"), (None, None, "m"), (None, None, None)], "id string, user_id string, email string")
    assert [r.id for r in store.with_user_id(rows).collect()] == ["i", "u", "m", ""]


def test_lookup_gives_the_first_match_or_nulls(spark):
    asked = spark.createDataFrame([("ines@mail.example",), ("nobody@mail.example",), (None,)], "email string")
    found = store.lookup_users(asked, users(spark), "email", [F.col("user_id")])
    assert keys(found, "email", "user_id") == {("ines@mail.example", "ines"), ("nobody@mail.example", None), (None, None)}


def test_no_sources_no_postings(spark):
    assert store.postings_of_sources(postings(spark), []).isEmpty()
    assert store.postings_of_sources(postings(spark), ["board"]).count() == 2


def test_snapshots_and_missing_tables(spark, tmp_path):
    root = str(tmp_path / "postings")
    assert tables.read_or_empty(spark, root, schemas.POSTINGS).isEmpty()
    path = tables.write_snapshot(postings(spark), root, 1, ["source_id"])
    stored = tables.read_or_empty(spark, path, schemas.POSTINGS)
    assert stored.schema == schemas.POSTINGS and keys(stored, "source_id", "job_id") == keys(postings(spark), "source_id", "job_id")
    with pytest.raises(ValueError):
        tables.read_or_empty(spark, path, schemas.USERS)


def test_documents_keep_missing_fields_as_null(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text('{"id": "b|1", "job_id": "1", "source_id": "b", "title": ""}\n{"job_id": "2", "source_id": "b", "tags": [1]}\n')
    docs = tables.read_documents(spark, str(path), schemas.POSTINGS)
    assert keys(docs, "job_id", "title") == {("1", ""), ("2", None)}
    path.write_text("no document\n")
    with pytest.raises(Exception, match="MALFORMED"):
        tables.read_documents(spark, str(path), schemas.POSTINGS).collect()


def test_append_log_keeps_earlier_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(2):
        tables.append_log(spark.range(n, n + 1), path)
    assert spark.read.parquet(path).count() == 2


def test_single_user_retries_only_failed_scores(spark):
    jobs = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "job_id string")
    done = spark.createDataFrame([("1", 0), ("2", None), ("3", 5)], "job_id string, score int")
    assert keys(worklist.unevaluated_postings(jobs, done), "job_id") == {("1",), ("4",)}
    assert keys(worklist.unevaluated_postings(jobs, done, retry_failed=False), "job_id") == {("4",)}


def test_figures_of_an_empty_store(spark):
    none = spark.createDataFrame([], schemas.LEGACY_EVALUATIONS)
    row = report.report_kpis(postings(spark), none).first()
    assert (row.total, row.evaluated, row.sent, row.avg_score, row.n_top) == (2, 0, 0, None, 0)


def test_run_notes(spark):
    def summary(new, scores):
        scored = spark.createDataFrame([(f"J{i}", s, i) for i, s in enumerate(scores)], "job_id string, score int, seq int")
        fresh = spark.range(new).withColumn("job_id", F.lit("x"))
        return report.run_summary(postings(spark), fresh, scored, scored.limit(0), ["seq"], manual=True).first()

    first = summary(3, [4, 9, 9])
    assert (first.notes, first.jobs_in_db, first.trigger) == ("3 new job(s); best: J1 (9/10)", 5, "manual")
    assert summary(3, []).notes == "3 new job(s) found"
    assert summary(0, [5]).notes == ""
