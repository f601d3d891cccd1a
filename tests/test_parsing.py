import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from jobweave.functions import parsing
from jobweave.functions.parsing import parse_responses
from jobweave.operators import scoring, tags

FENCE = "`" * 3

CASES = [
    ('{"score": 8, "summary": "ok"}', 8, "ok", None),
    (FENCE + 'json\n{"score": 8, "summary": "ok"}\n' + FENCE, 8, "ok", None),
    (FENCE + '{"score": 8, "summary": "ok"}' + FENCE + " \n", 8, "ok", None),
    ('{"score": "8", "summary": "ok"}', 8, "ok", None),
    ('{"score": " +0_8 ", "summary": "ok"}', 8, "ok", None),
    ('{"score": 8.7, "summary": "ok"}', 8, "ok", None),
    ('{"score": 1e1, "summary": "ok"}', 10, "ok", None),
    ('{"score": true, "summary": "ok"}', 1, "ok", None),
    ('{"score": 3, "score": 9, "summary": "last"}', 9, "last", None),
    ('{"score": 7, "summary": null}', 7, "None", None),
    ('{"score": 7, "summary": true}', 7, "True", None),
    ('{"score": 7, "summary": 12}', 7, "12", None),
    ('{"score": "8.7", "summary": "ok"}', None, None, "score is not an integer"),
    ('{"score": null, "summary": "ok"}', None, None, "score is not an integer"),
    ('{"score": [8], "summary": "ok"}', None, None, "score is not an integer"),
    ('{"score": 0, "summary": "ok"}', None, None, "score out of bounds"),
    ('{"score": 0.9, "summary": "ok"}', None, None, "score out of bounds"),
    ('{"score": 11, "summary": "ok"}', None, None, "score out of bounds"),
    ('{"score": 99999999999999999999999999, "summary": "ok"}', None, None, "score out of bounds"),
    ('{"score": 8}', None, None, "missing summary"),
    ('{"summary": "ok"}', None, None, "missing score"),
    ("[8]", None, None, "missing score"),
    ('{"score": 8, "summary": "ok"} Hope this helps', None, None, "invalid JSON"),
    ('{"score": 8, "summary": "ok"}}', None, None, "invalid JSON"),
    ('{"score": 8, "summary": "ok"}, "x": 1', None, None, "invalid JSON"),
    ('{"score": 8, "summary": "ok"}\n,\n"x": 1', None, None, "invalid JSON"),
    ('{"score": 8, "summary": "a}, b", "more": [{}, {}]}', 8, "a}, b", None),
    ("{'score': 8, 'summary': 'ok'}", None, None, "invalid JSON"),
    ('{"score": 08, "summary": "ok"}', None, None, "invalid JSON"),
    ('{"score": 8, "summary": "a\nb"}', None, None, "invalid JSON"),
    ("I cannot rate this", None, None, "invalid JSON"),
    ("", None, None, "invalid JSON"),
    (None, None, None, "invalid JSON"),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, response string")
    rows = {r.i: (r.score, r.summary, r.error) for r in parse_responses(df).collect()}
    assert rows == {i: c[1:] for i, c in enumerate(CASES)}


# Scores as they may be written, with the number each stands for; None where it stands for none.
scores = some.one_of(
    some.integers(-3, 14).map(lambda n: (n, n)),
    some.floats(-2, 13).map(lambda x: round(x, 3)).map(lambda x: (x, math.trunc(x))),
    some.booleans().map(lambda b: (b, 1 if b else 0)),
    some.integers(-3, 14).map(lambda n: (str(n), n)),
    some.sampled_from([(None, None), (" 7 ", 7), ("+4", 4), ("x", None), ("", None), ("1_0", 10), ("3.0", None)]),
)
# What stands before and behind an answer, and whether it may.
heads = some.sampled_from([("", True), (" ", True), (FENCE + "json\n", True), (FENCE, True), ("x", False), ("\u2003", True)])
tails = some.sampled_from([("", True), (" \n", True), ("\n" + FENCE, True), (FENCE, True), (" done", False), ("}", False), (", 1", False), ("\x1f", True)])


def built(score, summary, head, tail, drop):
    """A text, and the score and summary that must be read from it; None where it must be refused."""
    written, number = score
    members = {k: v for k, v in {"score": written, "summary": summary}.items() if k != drop}
    good = head[1] and tail[1] and drop is None and number is not None and 1 <= number <= 10
    return head[0] + json.dumps(members) + tail[0], (number, summary) if good else None


answers = some.builds(
    built, scores, some.text("ab\"\\{}é\n,:", max_size=6), heads, tails, some.sampled_from([None, None, None, "score", "summary"])
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(some.lists(answers, min_size=50, max_size=80))
def test_reads_what_was_written(spark, texts):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, response string")
    found = {r.i: (r.score, r.summary) if r.error is None else None for r in parse_responses(df).collect()}
    assert found == {i: expected for i, (_, expected) in enumerate(texts)}


@pytest.mark.parametrize(
    "message, kind, wait",
    [
        ("429 PerDay limit used up", "daily_quota", 0),
        ("limit PER_DAY", "daily_quota", 0),
        ("429", "quota", 65),
        ("Quota", "quota", 65),
        ("could not generate", "quota", 65),
        ("timeout", "other", 2),
        (None, None, None),
    ],
)
def test_error_classes(spark, message, kind, wait):
    row = scoring.classify_errors(spark.createDataFrame([(message,)], "message string")).first()
    assert (row.error_class, row.wait_s) == (kind, wait)


def test_json_is_parsed_once_per_row(spark):
    df = spark.createDataFrame([("{}",)], "response string")
    plan = parse_responses(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_attempts_stop_at_the_first_success(spark):
    rows = [
        ("p", 1, None, None, "e1"), ("p", 2, 7, "two", None), ("p", 3, 9, "three", None),
        ("q", 1, None, None, "e1"), ("q", 2, None, None, "e2"), ("q", 3, None, None, "e3"), ("r", 3, None, None, "e3"), ("r", 5, 9, "late", None),
    ]
    log = spark.createDataFrame(rows, "pair string, attempt int, score int, summary string, error string")
    found = {tuple(r) for r in scoring.attempt_outcomes(log, ["pair"]).collect()}
    assert found == {("p", 7, "two", None, 2), ("q", None, None, "e3", 3), ("r", 9, "late", None, 5)}


def test_quota_stop_per_user_and_per_run(spark):
    rows = [("a", 1, None), ("a", 2, "429 PerDay"), ("a", 3, None), ("b", 4, "timeout"), ("b", 5, None)]
    calls = spark.createDataFrame(rows, "user_id string, seq int, error string")
    per_user = {r.seq: r.state for r in scoring.apply_quota_stop(calls, ["seq"]).collect()}
    assert per_user == {1: "evaluated", 2: "stopped", 3: "stopped", 4: "failed", 5: "evaluated"}
    per_run = {r.seq: r.state for r in scoring.apply_quota_stop(calls, ["seq"], group=()).collect()}
    assert per_run == {1: "evaluated", 2: "stopped", 3: "stopped", 4: "stopped", 5: "stopped"}


def test_batch_scorer_runs_in_arrow_batches(spark):
    pairs = spark.range(10).withColumn("prompt", F.lit("p"))
    scorer = scoring.batch_scorer(lambda batch: '{"score": ' + (batch["id"] + 1).astype(str) + ', "summary": "s"}')
    assert {r.score for r in scoring.score_pairs(pairs, scorer).collect()} == set(range(1, 11))


def test_plain_answers_are_read_as_their_json(spark, monkeypatch):
    texts = ["", "ok", "a}, b", "é 漢字 \U0001f600 � ﻿ ", "tab\t", 'say \\"so\\"', "back\\\\", "\x7f", "x" * 100_000, "x" * 100_001, '", "score": 2, "x": "']
    numbers = ["7", "-7", "0", "-0", "07", "999999999", "1000000000", "7.0", '"7"', "null", "+7"]
    forms = ['{"score": %s, "summary": "%s"}', '\n{\r\n\t"score" :%s\n,\t"summary":  "%s"\n}\n', '{"score":%s,"summary":"%s"} ', FENCE + 'json\n{"score":%s,"summary":"%s"}\n' + FENCE, '{"score":%s,"summary":"%s"},', '{"score":%s,"summary":"%s"}}']
    answers = [f % (n, t) for f in forms for n in numbers for t in texts[:8]] + [forms[0] % (8, t) for t in texts[8:]]
    broken = F.concat(F.lit('{"score": 3, "summary": "a'), F.unhex(F.lit("FFEDA080C3")).cast("string"), F.lit('b"}'))
    df = spark.createDataFrame([(a,) for a in answers], "response string").unionByName(spark.range(1).select(broken.alias("response")))

    def read():
        return [tuple(r) for r in parse_responses(df).select("score", "summary", "error").collect()]

    quick = read()
    matches = df.filter(parsing.strip_fences(F.col("response")).rlike(parsing._PLAIN)).count()
    assert 60 < matches < df.count() // 2
    monkeypatch.setattr(parsing, "_PLAIN", r"(\Ax)(x\z)")
    assert read() == quick


def test_a_fallback_that_is_an_expression_needs_no_written_pairs(spark, monkeypatch):
    rows = [("a", ["x"], ["x", "y"]), ("b", ["x"], []), ("c", ["x"], None), ("d", [], ["x"])]
    pairs = spark.createDataFrame(rows, "user_id string, job_tags array<string>, user_tags array<string>")
    answer = F.concat(F.lit('{"score": 9, "summary": "'), F.col("user_id"), F.lit('"}'))

    def read(fallback):
        scored = scoring.score_pairs(pairs, lambda rows: tags.with_fallback(rows, fallback))
        return {r.user_id: (r.score, r.summary, r.error) for r in scored.collect()}

    want = {"a": (5, "1/2 tags matched", None), "b": (9, "b", None), "c": (9, "c", None), "d": (1, "0/1 tags matched", None)}
    assert read(lambda rows: rows.withColumn("response", answer)) == want
    monkeypatch.setattr(tags, "materialize", None)
    assert read(scoring.column_scorer(answer)) == want
