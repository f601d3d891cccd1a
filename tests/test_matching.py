"""Worklist, digests and feed on the small users and postings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import evaluations, keys, postings, registry, users
from jobweave.operators import alerts, feed, shortlist, store, worklist
from jobweave.operators import users as people
from jobweave.sources.registry import source_labels


@pytest.fixture(scope="module")
def active(spark):
    return people.active_users(users(spark), ["board"])


def test_worklist_holds_open_pairs_only(spark, active):
    jobs = postings(spark)
    done = evaluations(spark, [("ines", "P-17", 8, False)])
    open_pairs = worklist.worklist(active, jobs, done)
    assert keys(open_pairs, "user_id", "job_id") == {("ines", "P-40"), ("tomo", "P-17"), ("tomo", "P-40")}
    everything = evaluations(spark, [(u, j, 8, False) for u in ("ines", "tomo") for j in ("P-17", "P-40")])
    assert worklist.worklist(active, jobs, everything).isEmpty()


def test_failed_scores_are_retried_only_on_request(spark, active):
    jobs = postings(spark)
    failed = evaluations(spark, [("ines", "P-17", 0, False), ("ines", "P-40", None, False)])
    of_a = lambda df: keys(df.filter("user_id = 'ines'"), "job_id")
    assert of_a(worklist.worklist(active, jobs, failed)) == set()
    assert of_a(worklist.worklist(active, jobs, failed, retry_failed=True)) == {("P-17",)}


@pytest.mark.parametrize("retry", [False, True])
def test_counts_agree_with_the_listed_pairs(spark, active, retry):
    jobs = postings(spark)
    done = evaluations(spark, [("ines", "P-17", 0, False), ("tomo", "P-40", 3, True), ("tomo", "GONE", 3, True)])
    listed = {r.user_id: r["count"] for r in worklist.worklist(active, jobs, done, retry).groupBy("user_id").count().collect()}
    counted = {r.user_id: r.n_todo for r in worklist.worklist_counts(active, jobs, done, retry).collect()}
    by_source = {r.user_id: r.n_todo for r in worklist.worklist_by_source(active, jobs, done, retry).groupBy("user_id").agg(F.sum("n_todo").alias("n_todo")).collect()}
    assert counted == by_source == listed


@pytest.mark.parametrize("tile_rows", [512, 2])
def test_blocks_change_the_work_not_the_pairs(spark, monkeypatch, tile_rows):
    """Blocks untouched, done in part and done give the pairs a plain comparison gives, in any tiling."""
    monkeypatch.setattr(worklist, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(worklist, "PAIRS_PER_TASK", tile_rows * 3)
    jobs = [(f"J{i}", f"b{i % 3}", "t", "", "", "", "", "", "") for i in range(24)]
    people_rows = [(f"u{i}", None, None, f"p{i}", 7, ["b0", f"b{i % 3}"], None, True, None, None, None) for i in range(4)]
    done = [("u0", f"J{i}", 5, False) for i in range(0, 24, 3)] + [("u1", "J0", 5, False), ("u1", "J1", 0, False), ("u2", "J2", 3, False)]
    all_jobs = postings(spark, jobs).withColumn("run", F.col("job_id").substr(2, 2).cast("int") % 4)
    evals = evaluations(spark, done).withColumn("source_id", F.concat(F.lit("b"), F.substring("job_id", 2, 2).cast("int") % 3))
    known = {(u, j) for u, j, _, _ in done}
    expected = {(p[0], p[3], j[1], j[0], "t") for p in people_rows for j in jobs if j[1] in p[5] and (p[0], j[0]) not in known}
    for block in ([], ["run"]):
        pairs = worklist.worklist(users(spark, people_rows), all_jobs, evals, block=block, user_columns=["profile_text"])
        assert pairs.count() == len(expected)
        assert keys(pairs, "user_id", "profile_text", "source_id", "job_id", "title") == expected


def test_one_digest_for_the_user_whose_threshold_is_met(spark, active):
    done = evaluations(spark, [("ines", "P-17", 8, False), ("tomo", "P-17", 5, False)])
    labels = source_labels(registry(spark))
    due = alerts.due_matches(done, active, postings(spark))
    digests = alerts.user_digests(due, active, labels, "Mail").collect()
    assert [(d.user_id, d.recipient, d.n_matches) for d in digests] == [("ines", "ines@mail.example", 1)]
    assert digests[0].subject == "[Mail] 1 job match — BoJ"
    assert digests[0].greeting == "Hi Ines — 1 new match from BoJ"
    (line,) = alerts.digest_lines(due, postings(spark), labels).collect()
    assert line.headline == "[BoJ] Clock Repairer — Score 8/10"


def test_sent_or_unknown_matches_are_not_sent_again(spark, active):
    done = evaluations(spark, [("ines", "P-17", 8, True), ("ines", "P-40", 9, None)])
    assert alerts.due_matches(done, active, postings(spark)).isEmpty()


def test_only_delivered_lines_are_marked(spark, active):
    done = evaluations(spark, [("ines", "P-17", 8, False), ("ines", "GONE", 9, False), ("tomo", "GONE", 9, False)])
    due = alerts.due_matches(done, active, postings(spark))
    delivered = alerts.delivered_keys(due, active)
    assert keys(delivered, "user_id", "job_id") == {("ines", "P-17")}
    everything = alerts.delivered_keys(due, active, alerts.pending_evaluations(done, active))
    assert keys(everything, "user_id", "job_id") == {("ines", "P-17"), ("ines", "GONE")}
    marked = store.mark_sent(done, delivered)
    assert keys(marked.filter("email_sent"), "user_id", "job_id") == {("ines", "P-17")}


def test_users_without_any_address_get_no_digest(spark):
    silent = people.active_users(users(spark), ["board"]).withColumns({"email": F.lit(""), "notification_email": F.lit(None).cast("string")})
    done = evaluations(spark, [("ines", "P-17", 8, False)])
    due = alerts.due_matches(done, silent, postings(spark))
    assert due.count() == 1
    assert alerts.user_digests(due, silent, source_labels(registry(spark)), "Mail").isEmpty()
    assert alerts.delivered_keys(due, silent).isEmpty()


def test_feed_lists_scored_postings_first(spark, active):
    rows = feed.feed(active, postings(spark), evaluations(spark, [("ines", "P-40", 4, False)])).filter("user_id = 'ines'")
    assert [(r.position, r.job_id, r.score, r.total) for r in rows.orderBy("position").collect()] == [
        (1, "P-40", 4, 2), (2, "P-17", None, 2),
    ]


def test_feed_minimum_drops_unscored_postings(spark, active):
    assert feed.feed(active, postings(spark), evaluations(spark, []), min_score=7).isEmpty()
    done = evaluations(spark, [("ines", "P-17", 7, False), ("ines", "P-40", 6, False)])
    assert keys(feed.feed(active, postings(spark), done, min_score=7), "user_id", "job_id") == {("ines", "P-17")}


def test_feed_rejects_bad_pages(spark, active):
    for bad in ({"page": 0}, {"limit": 0}, {"min_score": 11}):
        with pytest.raises(ValueError):
            feed.feed(active, postings(spark), evaluations(spark, []), **bad)


def test_totals_of_empty_pages(spark, active):
    done = evaluations(spark, [("ines", "P-17", 7, False)])
    assert keys(feed.feed_totals(active, postings(spark), done, limit=1), "user_id", "total", "n_pages") == {("ines", 2, 2), ("tomo", 2, 2)}
    assert keys(feed.feed_totals(active, postings(spark), done, min_score=7), "user_id", "total", "n_pages") == {("ines", 1, 1), ("tomo", 0, 1)}
    assert feed.feed(active, postings(spark), done, page=5).isEmpty()


def test_one_id_on_two_boards(spark):
    """Each board's posting has its own evaluation, line and row."""
    jobs = postings(spark, [("1", b, f"at {b}", "", "", "", "", "", "") for b in ("a", "b")])
    people_rows = users(spark, [("u", "u@mail.example", "U", "p", 5, ["a", "b"], None, True, None, None, None)])
    one = evaluations(spark, [("u", "1", 8, False)]).withColumn("source_id", F.lit("a"))
    both = one.unionByName(one.withColumns({"source_id": F.lit("b"), "score": F.lit(6)}))
    labels = jobs.select("source_id", F.col("source_id").alias("label"))
    due = alerts.due_matches(one, people_rows, jobs)
    assert keys(alerts.digest_lines(due, jobs, labels), "source_id", "line_no", "score") == {("a", 1, 8)}
    due = alerts.due_matches(both, people_rows, jobs)
    assert keys(alerts.digest_lines(due, jobs, labels), "source_id", "line_no", "score") == {("a", 1, 8), ("b", 2, 6)}
    assert [r.n_matches for r in alerts.user_digests(due, people_rows, labels, "Mail").collect()] == [2]
    assert [(r.position, r.source_id, r.score, r.total) for r in feed.feed(people_rows, jobs, one).orderBy("position").collect()] == [(1, "a", 8, 2), (2, "b", None, 2)]
    assert [(r.position, r.source_id, r.score, r.total) for r in feed.feed(people_rows, jobs, both).orderBy("position").collect()] == [(1, "a", 8, 2), (2, "b", 6, 2)]
    assert keys(worklist.worklist(people_rows, jobs, one), "source_id", "job_id") == {("b", "1")}
    assert keys(worklist.worklist_by_source(people_rows, jobs, one), "source_id", "n_todo") == {("b", 1)}
    marked = store.mark_sent(both, alerts.delivered_keys(alerts.due_matches(one, people_rows, jobs), people_rows))
    assert keys(marked, "source_id", "email_sent") == {("a", True), ("b", False)}


def test_summaries_are_whole_unless_asked(spark, active):
    done = evaluations(spark, [("ines", "P-17", 8, False)]).withColumn("summary", F.lit("word " * 100))
    due, labels = alerts.due_matches(done, active, postings(spark)), source_labels(registry(spark))
    texts = [alerts.digest_lines(due, postings(spark), labels, summary_chars=n).first().short_summary for n in (None, 500, 20)]
    assert texts == ["word " * 100, "word " * 100, "word " * 4 + "..."]


def test_pages_partition_the_feed(spark):
    """All pages together are every candidate once, in one order, whatever is scored."""
    boards = ["b1", "b2", "b3"]
    jobs = [(f"J{i:03d}", boards[i % 3] if i % 2 else "b1", f"T{i}", "", "", "", "", "", "") for i in range(45)]
    people_rows = [("u1", None, None, None, 7, ["b1", "b2"], None, True, None, None, None), ("u2", None, None, None, 7, ["b3", "b3", "none"], None, True, None, None, None), ("u3", None, None, None, 7, [], None, True, None, None, None)]
    done = [("u1", f"J{i:03d}", 1 + i % 10 if i % 5 else None, False) for i in range(0, 45, 4)] + [("u2", "J005", 9, True)]
    all_jobs, all_users, evals = postings(spark, jobs), users(spark, people_rows), evaluations(spark, done)
    evals = evals.drop("source_id").join(all_jobs.select("source_id", "job_id"), "job_id")
    score = {(u, j): s for u, j, s, _ in done}
    for user, wanted in (("u1", {"b1", "b2"}), ("u2", {"b3"}), ("u3", set())):
        mine = [(j[1], j[0], score.get((user, j[0]))) for j in jobs if j[1] in wanted]
        expected = [j for _, j, _ in sorted(mine, key=lambda r: (r[2] is None, -(r[2] or 0), r[0], r[1]))]
        seen = []
        for page in range(1, 9):
            rows = feed.feed(all_users, all_jobs, evals, page=page, limit=6).filter(F.col("user_id") == user).orderBy("position").collect()
            assert all(r.total == len(expected) and r.n_pages == max(1, -(-len(expected) // 6)) for r in rows)
            seen += [r.job_id for r in rows]
        assert seen == expected


def test_scorable_users_need_a_profile(spark):
    rows = spark.createDataFrame([("a", " \t\n"), ("b", None), ("c", " text ")], "user_id string, profile_text string")
    found = {r.user_id: (r.profile_text, r.reject_reason) for r in people.scorable(rows).collect()}
    assert found == {"a": ("", "no profile text"), "b": ("", "no profile text"), "c": ("text", None)}


@pytest.mark.parametrize("tile_rows, cluster_rows", [(2048, None), (3, None), (2048, 5), (3, 2)])
def test_shortlist_against_brute_force(spark, monkeypatch, tile_rows, cluster_rows):
    monkeypatch.setattr(shortlist, "TILE_ROWS", tile_rows)
    random = np.random.default_rng(5)
    vectors = random.integers(-2, 3, (60, 4)).astype(float)
    # Two thirds of the postings on one board; equal vectors give ties.
    jobs = [("b0" if i % 3 else f"b{i % 4}", f"J{i}", vectors[i].tolist()) for i in range(40)]
    seekers = [(f"u{i}", ["b0", f"b{i % 4}"], vectors[20 + i].tolist()) for i in range(40)]

    def likeness(a, b):
        size = np.linalg.norm(a) * np.linalg.norm(b)
        return float(np.rint(np.dot(a, b) / size * 1e9) / 1e9) if size else 0.0

    expected = set()
    for user, boards, vector in seekers:
        found = sorted((-likeness(vector, v), s, j) for s, j, v in jobs if s in boards)[:7]
        expected |= {(user, n, s, j, -x) for n, (x, s, j) in enumerate(found, 1)}
    nearest = shortlist.shortlist(
        spark.createDataFrame(seekers, "user_id string, enabled_sources array<string>, vector array<double>"),
        spark.createDataFrame(jobs, "source_id string, job_id string, vector array<double>"),
        k=7,
        cluster_rows=cluster_rows,
    )
    assert keys(nearest, "user_id", "position", "source_id", "job_id", "similarity") == expected


def test_shortlist_skips_clusters(spark):
    """Postings in tight bundles: a user looks into few clusters, and finds what a comparison with all finds."""
    random = np.random.default_rng(6)
    bundles = random.normal(size=(40, 16))
    near = lambda n: bundles[n % 40] + random.normal(size=16) * 0.02
    jobs = spark.createDataFrame([("b", f"J{i:04}", near(i).tolist()) for i in range(1200)], "source_id string, job_id string, vector array<double>")
    people = spark.createDataFrame([(f"u{i}", ["b", "none"], near(i).tolist()) for i in range(60)], "user_id string, enabled_sources array<string>, vector array<double>")
    columns = ["user_id", "position", "source_id", "job_id", "similarity"]
    assert keys(shortlist.shortlist(people, jobs, 10, cluster_rows=20), *columns) == keys(shortlist.shortlist(people, jobs, 10), *columns)
    placed, balls = shortlist.clustered(jobs, 20)
    assert placed.count() == 1200 and balls.count() > 30 and balls.agg(F.sum("n")).first()[0] == 1200
    seekers = people.select("user_id", F.lit("b").alias("source_id"), "vector")
    first = shortlist.to_visit(seekers.withColumn("least", F.lit(None).cast("double")), balls, 10)
    second = shortlist.to_visit(seekers.withColumn("least", F.lit(0.99)), balls, 10)
    looked_into = first.unionByName(second).join(balls, ["source_id", "cluster"])
    assert looked_into.select("user_id", "cluster").distinct().count() == looked_into.count()
    assert looked_into.agg(F.sum("n")).first()[0] < 0.2 * 60 * 1200
    assert second.count() + first.count() < 60 * balls.count()
    everywhere = shortlist.to_visit(seekers.withColumn("least", F.lit(-2.0)), balls, 10)
    assert everywhere.count() + first.count() == 60 * balls.count()


def test_shortlist_sends_a_user_once_for_many_clusters(spark, monkeypatch):
    """Where the bound rules nothing out, what is sent follows the users and postings and not the clusters."""
    random = np.random.default_rng(7)
    sent = []
    visit = shortlist.to_visit

    def counted(*args):
        found = visit(*args)
        sent.append(found.count())
        return found

    monkeypatch.setattr(shortlist, "to_visit", counted)
    jobs = spark.createDataFrame([("b", f"J{i:04}", random.normal(size=24).tolist()) for i in range(600)], "source_id string, job_id string, vector array<double>")
    people = spark.createDataFrame([(f"u{i}", ["b"], random.normal(size=24).tolist()) for i in range(40)], "user_id string, enabled_sources array<string>, vector array<double>")
    columns = ["user_id", "position", "source_id", "job_id", "similarity"]
    found = keys(shortlist.shortlist(people, jobs, 10, cluster_rows=4), *columns)
    assert sum(sent) <= 2 * 40
    assert found == keys(shortlist.shortlist(people, jobs, 10), *columns)


def test_feed_moves_no_unscored_row_by_itself(spark, active):
    """The rows that fill a page up come out of the user's row; the anti-join and windows over single rows are gone."""
    plan = feed.feed(active, postings(spark), evaluations(spark, []), limit=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "LeftAnti" not in plan


def test_feed_of_repeated_rows(spark):
    """Postings, users and remarks that come twice are counted and listed twice."""
    jobs = postings(spark).limit(1).drop("source_id", "job_id").crossJoin(
        spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2"), ("a", None), ("b", "1")], "source_id string, job_id string")
    )
    people_rows = spark.createDataFrame([("u", ["a"]), ("u", ["a"]), ("v", ["b", "a"])], "user_id string, enabled_sources array<string>")
    done = spark.createDataFrame(
        [("v", "a", "1", 5, "good"), ("u", "a", "2", None, "x"), ("u", "a", "2", None, "y")],
        "user_id string, source_id string, job_id string, score int, summary string",
    )
    found = feed.feed(people_rows, jobs, done, limit=4)
    rows = sorted((r.user_id, r.position, r.source_id, r.job_id, r.score, r.summary, r.total) for r in found.collect() if r.user_id == "v")
    # The posting without id keeps its place and is not shown; each of two equal rows meets both postings.
    assert rows == [("v", 1, "a", "1", 5, "good", 5), *[("v", n, "a", "2", None, None, 5) for n in (3, 3, 4, 4)]]
    mine = sorted((r.position, r.job_id, r.summary or "", r.total) for r in found.collect() if r.user_id == "u")
    assert mine == [(2, "1", "", 8), *[(n, "2", said, 8) for n in (3, 4) for said in ("x", "x", "y", "y")]]
