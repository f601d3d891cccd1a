"""Whole cycles on the small tables."""

import shutil

import pytest

from pyspark.sql import functions as F

from fixtures import POSTINGS, evaluations, keys, postings, registry, users
from jobweave import schemas
from jobweave.operators import report, scoring, shortlist
from jobweave.plans import cycle, single_user

CONFIGS = {"board": {"enabled": True}}
SCORES = {("ines", "P-17"): 8, ("ines", "P-40"): 3, ("tomo", "P-17"): 5, ("tomo", "P-40"): 5}


def scorer(rows):
    score = F.lit(None).cast("string")
    for (user, job), value in SCORES.items():
        score = F.when((F.col("user_id") == user) & (F.col("job_id") == job), F.lit(str(value))).otherwise(score)
    return rows.withColumn("response", F.concat(F.lit('{"score": '), score, F.lit(', "summary": "s"}')))


def run(tables, spark, number, rows, scorer=scorer):
    return cycle.run_cycle(
        tables, number, CONFIGS, {"board": lambda s, c: postings(s, rows)}, users(spark), registry(spark),
        scorer, ["board"], "Mail", f"2025-01-0{number}T08:00:00", everything,
    )


def everything(postings):
    """A shortlist of all stored postings for both users."""
    people = postings.sparkSession.createDataFrame([("ines",), ("tomo",)], "user_id string").withColumn("board", F.lit("board"))
    return people.join(postings.select("source_id", "job_id"), F.col("board") == F.col("source_id")).drop("board")


def test_two_runs(spark, tmp_path):
    tables = cycle.RunTables(spark, str(tmp_path))
    digests, lines = run(tables, spark, 1, POSTINGS)
    assert keys(digests, "user_id", "n_matches") == {("ines", 1)}
    assert keys(lines, "user_id", "job_id", "line_no") == {("ines", "P-17", 1)}
    assert keys(tables.evaluations(1), "user_id", "job_id", "score", "email_sent") == {
        (u, j, s, (u, j) == ("ines", "P-17")) for (u, j), s in SCORES.items()
    }

    # The second run sees one more posting; nothing is scored or sent twice.
    SCORES.update({("ines", "P-52"): 9, ("tomo", "P-52"): 6})
    asked = []

    def counting(rows):
        asked.append(rows)
        return scorer(rows)

    more = [*POSTINGS, ("P-52", "board", "Third", "", "", "", "", "", "2025-01-02")]
    digests, lines = run(tables, spark, 2, more, counting)
    assert keys(asked[0], "job_id") <= {("P-52",)}
    assert keys(tables.postings(2), "job_id", "run") == {("P-17", 1), ("P-40", 1), ("P-52", 2)}
    assert keys(lines, "user_id", "job_id") == {("ines", "P-52"), ("tomo", "P-52")}
    assert keys(digests, "user_id", "subject") == {(u, "[Mail] 1 job match — BoJ") for u in ("ines", "tomo")}
    history = {r.run_at.day: r for r in spark.read.parquet(f"{tmp_path}/run_history").collect()}
    assert 0 < history[1].duration_s < 1000
    assert (history[1].jobs_in_db, history[1].new_jobs, history[1].evaluated, history[1].emails_sent) == (2, 2, 4, 1)
    assert history[2].notes == "1 new job(s); best: P-52 (9/10)" and history[2].jobs_in_db == 3

    # Repeating the run gives the same state.
    before = sorted(map(str, tables.evaluations(2).collect()))
    run(tables, spark, 2, more)
    assert sorted(map(str, tables.evaluations(2).collect())) == before
    for key in (("ines", "P-52"), ("tomo", "P-52")):
        SCORES.pop(key)


def test_failed_scores_can_be_scored_again(spark, tmp_path):
    tables = cycle.RunTables(spark, str(tmp_path), rescored=True)
    cycle.ingest_run(tables, 1, CONFIGS, {"board": lambda s, c: postings(s)}, F.lit("2025-01-01"))
    failed = evaluations(spark, [("ines", "P-17", 0, False), ("ines", "P-40", 6, False)])
    tables.write(failed, "evaluations", 1)
    cycle.evaluate_run(tables, 2, users(spark).filter("user_id = 'ines'"), scorer, ["board"], F.lit("2025-01-02"), all_pairs=True)
    assert keys(tables.evaluations(2), "job_id", "score") == {("P-17", 8), ("P-40", 6)}


def test_notifying_reads_no_old_evaluations(spark, tmp_path):
    tables = cycle.RunTables(spark, str(tmp_path))
    run(tables, spark, 1, POSTINGS)
    shutil.rmtree(tmp_path / "evaluations" / "run=1")
    shutil.rmtree(tmp_path / "deliveries" / "run=1")
    tables.write(evaluations(spark, []), "evaluations", 2)
    eager = users(spark).withColumn("score_threshold", F.lit(5))
    digests, lines = cycle.notify_run(tables, 2, eager, registry(spark), ["board"], "Mail")
    # What was below a threshold is still there when the threshold falls; what was sent is not.
    assert keys(lines, "user_id", "job_id") == {("tomo", "P-17"), ("tomo", "P-40")}
    assert keys(tables.waiting(3), "user_id", "job_id") == {("ines", "P-40")}


def test_matches_of_failed_and_skipped_runs_are_sent(spark, tmp_path):
    tables = cycle.RunTables(spark, str(tmp_path))
    run(tables, spark, 1, POSTINGS)
    tables.write(evaluations(spark, [("tomo", "P-52", 9, False), ("ines", "P-52", 9, False)]), "evaluations", 2)
    tables.write(spark.createDataFrame([("ines", "board", "P-52")], cycle.DELIVERIES), "deliveries", 2)
    # Run 2 has delivered one of its matches and failed before its pending rows; 3 is skipped.
    tables.write(evaluations(spark, []), "evaluations", 4)
    left = {("ines", "P-40"), ("tomo", "P-17"), ("tomo", "P-40"), ("tomo", "P-52")}
    assert keys(tables.waiting(4), "user_id", "job_id") == left
    # So does a pending folder that was not committed.
    (tmp_path / "pending" / "run=2").mkdir()
    assert keys(tables.waiting(4), "user_id", "job_id") == left
    # A store without any pending rows falls back to the whole history.
    shutil.rmtree(tmp_path / "pending")
    assert keys(tables.waiting(4), "user_id", "job_id") == left
    again = cycle.RunTables(spark, str(tmp_path), rescored=True)
    tables.write(evaluations(spark, [("tomo", "P-17", 10, False)]), "evaluations", 4)
    assert keys(again.waiting(4), "user_id", "job_id", "score") == {("ines", "P-40", 3), ("tomo", "P-17", 10), ("tomo", "P-40", 5), ("tomo", "P-52", 9)}


def test_single_user_batches_go_on_after_failed_and_skipped_runs(spark, tmp_path):
    jobs = postings(spark).drop("source_id").withColumn("scraped_at", F.lit("2024-10-07").cast("timestamp"))

    def fixed(rows):
        return rows.withColumn("response", F.lit('{"score": 9, "summary": "s"}'))

    def batch(records, run):
        return single_user.run_batch(spark, str(tmp_path), records, "profile", fixed, 7, "Mail", f"2025-01-0{run}T08:00:00", run)

    assert keys(batch(jobs.filter("job_id = 'P-17'"), 1), "job_id") == {("P-17",)}
    batch(jobs, 2)
    shutil.rmtree(tmp_path / "evaluations" / "run=2")  # as if run 2 had failed before its end
    assert keys(batch(jobs.limit(0), 4), "job_id") == {("P-40",)}  # of run 2, and P-17 not again


def test_all_pairs_are_listed_only_on_request(spark, tmp_path):
    tables = cycle.RunTables(spark, str(tmp_path))
    cycle.ingest_run(tables, 1, CONFIGS, {"board": lambda s, c: postings(s)}, F.lit("2025-01-01"))
    with pytest.raises(ValueError, match="shortlist"):
        cycle.evaluate_run(tables, 1, users(spark), scorer, ["board"], F.lit("2025-01-01"))
    asked = []

    def looking(rows):
        asked.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return scorer(rows)

    cycle.evaluate_run(tables, 1, users(spark), looking, ["board"], F.lit("2025-01-01"), everything)
    assert "_tile" not in asked[0]
    found = cycle.evaluate_run(tables, 2, users(spark), scorer, ["board"], F.lit("2025-01-02"), all_pairs=True)
    assert found.isEmpty()


def test_one_id_on_two_boards_through_a_cycle(spark, tmp_path):
    tables = cycle.RunTables(spark, str(tmp_path))
    person = users(spark, [("u", "u@mail.example", "U", "profile", 5, ["a", "b"], None, True, None, None, None)])
    loaders = {b: lambda s, c, b=b: postings(s, [("1", b, b, "", "", "", "", "", "x")]) for b in ("a", "b")}
    digests, lines = cycle.run_cycle(
        tables, 1, {b: {"enabled": True} for b in loaders}, loaders, person, registry(spark),
        lambda rows: rows.withColumn("response", F.lit('{"score": 8, "summary": "s"}')), [], "Mail", "2025-01-01T08:00:00", all_pairs=True,
    )
    assert keys(tables.scores(1), "user_id", "source_id", "job_id") == {("u", "a", "1"), ("u", "b", "1")}
    assert keys(digests, "n_matches") == {(2,)} and keys(lines, "source_id", "line_no") == {("a", 1), ("b", 2)}
    assert tables.deliveries(1).count() == 2


def test_a_shortlist_limits_the_pairs(spark, tmp_path):
    tables = cycle.RunTables(spark, str(tmp_path))
    cycle.ingest_run(tables, 1, CONFIGS, {"board": lambda s, c: postings(s)}, F.lit("2025-01-01"))
    jobs = postings(spark).select("source_id", "job_id", F.when(F.col("job_id") == "P-17", F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.6), F.lit(0.8))).alias("vector"))
    people = users(spark).select("user_id", "enabled_sources", F.array(F.lit(0.0), F.lit(2.0)).alias("vector"))
    nearest = shortlist.shortlist(people, jobs, k=1)
    assert keys(nearest, "user_id", "job_id", "similarity") == {(u, "P-40", 0.8) for u in ("ines", "tomo", "vera")}
    cycle.evaluate_run(tables, 1, users(spark), scorer, ["board"], F.lit("2025-01-01"), nearest)
    assert keys(tables.scores(1), "user_id", "job_id", "score") == {("ines", "P-40", 3), ("tomo", "P-40", 5)}
    again = cycle.evaluate_run(tables, 2, users(spark), scorer, ["board"], F.lit("2025-01-02"), nearest)
    assert again.isEmpty()


def test_daily_quota_leaves_the_rest_for_the_next_run(spark, tmp_path):
    tables = cycle.RunTables(spark, str(tmp_path))

    def exhausted(rows):
        failure = F.when(F.col("job_id") == "P-40", F.lit("429 PerDay"))
        return rows.withColumns({"response": F.lit('{"score": 8, "summary": "s"}'), "failure": failure})

    cycle.ingest_run(tables, 1, CONFIGS, {"board": lambda s, c: postings(s)}, F.lit("2025-01-01"))
    states = cycle.evaluate_run(tables, 1, users(spark), exhausted, ["board"], F.lit("2025-01-01"), everything)
    assert keys(states, "user_id", "job_id", "state") == {(u, j, s) for u in ("ines", "tomo") for j, s in (("P-17", "evaluated"), ("P-40", "stopped"))}


def test_failed_pairs_are_asked_three_times(spark):
    pairs = spark.createDataFrame([("ok",), ("flaky",), ("bad",), ("quota",)], "job_id string")
    rounds = []

    def scorer(rows):
        rounds.append(sorted(r.job_id for r in rows.collect()))
        good = (F.col("job_id") == "ok") | ((F.col("job_id") == "flaky") & F.lit(len(rounds) == 2))
        failure = F.when(F.col("job_id") == "quota", F.lit("PerDay limit"))
        return rows.withColumns({"response": F.when(good, '{"score": 8, "summary": "s"}').otherwise("?"), "failure": failure})

    found = scoring.score_with_attempts(pairs, scorer, ["job_id"])
    assert keys(found, "job_id", "score", "error", "n_attempts") == {
        ("ok", 8, None, 1), ("flaky", 8, None, 2), ("bad", None, "invalid JSON", 3), ("quota", None, "PerDay limit", 1),
    }
    assert rounds == [["bad", "flaky", "ok", "quota"], ["bad", "flaky"], ["bad"]]


def test_single_user_cycle(spark, tmp_path):
    jobs = postings(spark).drop("source_id").withColumn("scraped_at", F.lit("2024-10-15").cast("timestamp"))
    stored, new = jobs.filter("job_id = 'P-17'"), jobs.filter("job_id = 'P-40'")
    earlier = spark.createDataFrame([("P-17", 0, "failed", None, False)], schemas.LEGACY_EVALUATIONS)

    def fixed(rows):
        score = F.when(F.col("job_id") == "P-17", "9").otherwise("4")
        return rows.withColumn("response", F.concat(F.lit('{"score": '), score, F.lit(', "summary": "s"}')))

    evaluations, results = single_user.evaluate(new, stored, earlier, " profile ", fixed, F.lit("2025-01-01"))
    assert keys(results, "job_id", "state") == {("P-17", "evaluated"), ("P-40", "evaluated")}
    mails, after = single_user.notify(evaluations, jobs, 7, "Mail")
    (mail,) = mails.collect()
    assert mail.subject == "[Mail] Score 9/10 — Clock Repairer"
    assert keys(after, "job_id", "score", "email_sent") == {("P-17", 9, True), ("P-40", 4, False)}
    runs = spark.createDataFrame([], schemas.RUN_HISTORY)
    single_user.report_tables(jobs, after, runs, F.lit("2024-12-25").cast("date"), str(tmp_path))
    kpis = spark.read.parquet(f"{tmp_path}/kpis").first()
    assert (kpis.total, kpis.evaluated, kpis.sent, kpis.avg_score, kpis.n_top) == (2, 2, 1, 6.5, 1)
    detail = {r.job_id: (r.is_soon, r.is_expired) for r in spark.read.parquet(f"{tmp_path}/detail").collect()}
    assert detail == {"P-17": (True, False), "P-40": (True, True)}


def test_single_user_batches(spark, tmp_path):
    jobs = postings(spark).drop("source_id").withColumn("scraped_at", F.lit("2024-10-07").cast("timestamp"))

    def fixed(rows):
        score = F.when(F.col("job_id") == "P-17", "9").otherwise("4")
        return rows.withColumn("response", F.concat(F.lit('{"score": '), score, F.lit(', "summary": "s"}')))

    def batch(records, run):
        return single_user.run_batch(spark, str(tmp_path), records, "profile", fixed, 7, "Mail", f"2025-01-0{run}T08:00:00", run)

    assert keys(batch(jobs.filter("job_id = 'P-40'"), 1), "job_id") == set()
    assert keys(batch(jobs, 2), "job_id", "score") == {("P-17", 9)}
    assert keys(batch(jobs, 2), "job_id", "score") == {("P-17", 9)}  # the same run again
    assert keys(batch(jobs, 3), "job_id") == set()
    runs = {r.run_at.day: r for r in spark.read.parquet(f"{tmp_path}/run_history").collect()}
    assert [(runs[d].jobs_in_db, runs[d].new_jobs, runs[d].evaluated, runs[d].emails_sent) for d in (1, 2, 3)] == [(1, 1, 1, 0), (2, 1, 1, 1), (2, 0, 0, 0)]
    assert all(r.duration_s > 0 for r in runs.values())
    assert spark.read.parquet(f"{tmp_path}/report/kpis").first().sent == 1


def test_report_columns_sort_by_type(spark):
    rows = [("1", "b", "2025-6-3", 2), ("2", "A", "2025-06-30", 10), ("3", "c", "soon", None)]
    jobs = spark.createDataFrame([(j, t, d) for j, t, d, _ in rows], "job_id string, title string, deadline string").withColumns({"location": F.lit(""), "contract_type": F.lit("")})
    evals = spark.createDataFrame([(j, s, False) for j, _, _, s in rows if s], "job_id string, score int, email_sent boolean")
    detail = report.report_detail(jobs, evals, F.lit("2025-01-01").cast("date"))
    order = lambda column, up: [r.job_id for r in report.report_sorted(detail, column, up).collect()]
    assert order("title", True) == ["2", "1", "3"]
    assert order("score", False) == ["2", "1", "3"]
    assert order("deadline", True) == ["1", "2", "3"]
    assert order("deadline", False) == ["2", "1", "3"]
