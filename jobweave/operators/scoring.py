"""Prompts, the scorer hook, attempts and the daily-quota stop."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.parsing import error_class, parse_responses, wait_seconds
from ..session import materialize

MAX_ATTEMPTS = 3  # calls a pair gets at most in a live run

# Adds a text column `response` to (user, posting) rows, and optionally `failure`, the message of a
# call that gave no answer.
Scorer = Callable[[DataFrame], DataFrame]

INSTRUCTIONS = (
    "Rate from 1 to 10 how well the posting fits the candidate and describe the role in a few "
    'sentences. Answer with one JSON object: {"score": <1-10>, "summary": "<text>"}.'
)


def posting_text(default_source: str = "Job Board", max_chars: int | None = None) -> Column:
    """Labelled posting fields, then the description, whole or its first `max_chars` characters."""
    source = F.coalesce(F.nullif(F.upper("source_id"), F.lit("")), F.lit(default_source))

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"{label}: "), value, F.lit("\n"))

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("not given"))

    description = F.coalesce("description_raw", F.lit(""))
    return F.concat(
        line("board", source),
        line("position", known("title")),
        line("place", known("location")),
        line("kind of contract", known("contract_type")),
        line("open until", known("deadline")),
        line("link", known("url")),
        F.lit("\n"),
        description if max_chars is None else F.substring(description, 1, max_chars),
    )


def build_prompts(pairs: DataFrame, instructions: str = INSTRUCTIONS, max_chars: int | None = None) -> DataFrame:
    """Add `prompt` to rows that carry the posting's fields and the user's `profile_text`."""
    prompt = F.concat(
        F.lit("Candidate:\n"),
        F.col("profile_text"),
        F.lit("\n\nPosting:\n"),
        posting_text(max_chars=max_chars),
        F.lit("\n\n" + instructions),
    )
    return pairs.withColumn("prompt", prompt)


def column_scorer(answer: Column) -> Scorer:
    """Scorer whose answer is an expression over the pairs, which it names as `answer`, so that scorers chosen by
    row need no pass of their own."""

    def scorer(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("response", answer)

    scorer.answer = answer
    return scorer


def batch_scorer(score_batch: Callable[[pd.DataFrame], pd.Series]) -> Scorer:
    """Scorer from a function over Arrow batches, for models that Spark expressions cannot call.

    Build clients inside `score_batch`: it runs in the executors.
    """

    def scorer(pairs: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.assign(response=score_batch(batch))

        schema = StructType(pairs.schema.fields + [StructField("response", StringType())])
        return pairs.mapInPandas(run, schema)

    return scorer


def score_pairs(pairs: DataFrame, scorer: Scorer) -> DataFrame:
    """Run a scorer and read its answers: adds score, summary and error. Answers are never trusted."""
    answered = scorer(pairs)
    if "failure" not in answered.columns:
        return parse_responses(answered).drop("response")
    came = F.col("failure").isNull()
    return (
        parse_responses(answered)
        .withColumns({name: F.when(came, F.col(name)) for name in ("score", "summary")})
        .withColumn("error", F.coalesce("failure", "error"))
        .drop("response", "failure")
    )


def score_with_attempts(
    pairs: DataFrame,
    scorer: Scorer,
    key: Sequence[str],
    attempts: int = MAX_ATTEMPTS,
    rebuild: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Results per key after up to `attempts` calls: key, score, summary, error and n_attempts.

    Failed pairs are asked again, except after an exhausted daily quota. The answers of each round are
    written before use, so that a pair is put to the scorer once per round. `rebuild` makes pairs of their
    keys, so that a retry starts from the failed keys; without it they are looked up in `pairs`.
    """
    settled, rows = [], pairs
    for attempt in range(1, attempts + 1):
        answers = score_pairs(rows, scorer).select(*key, "score", "summary", "error")
        answers = materialize(answers.withColumn("n_attempts", F.lit(attempt)), f"answers-{attempt}")
        failed = F.coalesce(error_class(F.col("error")) != "daily_quota", F.lit(False))
        again = answers.filter(failed).select(*key)
        if attempt == attempts or again.isEmpty():
            settled.append(answers)
            break
        settled.append(answers.filter(~failed))
        rows = rebuild(again) if rebuild else pairs.join(again, list(key), "left_semi")
    return reduce(DataFrame.unionByName, settled)


def classify_errors(df: DataFrame, message: str = "message") -> DataFrame:
    classified = df.withColumn("error_class", error_class(F.col(message)))
    return classified.withColumn("wait_s", wait_seconds(F.col("error_class")))


def attempt_outcomes(attempts: DataFrame, key: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Result per pair from a log of parsed attempts (`attempt`, `score`, `summary`, `error`).

    The first success counts, later attempts do not; without one the last error is kept. The whole log is
    read, however many attempts it holds.
    """
    order = F.struct("attempt", *tie)
    good = F.col("error").isNull()
    first_good = F.min(F.when(good, order))
    first_at = F.min_by(F.struct("score", "summary"), F.when(good, order))
    last_error = F.max_by("error", F.when(~good, order))
    outcome = (
        attempts.groupBy(*key)
        .agg(
            first_good.alias("_good"),
            first_at.alias("_result"),
            last_error.alias("_error"),
            F.max("attempt").alias("_last"),
        )
    )
    succeeded = F.col("_good").isNotNull()
    return outcome.select(
        *key,
        F.col("_result.score").alias("score"),
        F.col("_result.summary").alias("summary"),
        F.when(~succeeded, F.col("_error")).alias("error"),
        F.when(succeeded, F.col("_good.attempt")).otherwise(F.col("_last")).alias("n_attempts"),
    )


def apply_quota_stop(results: DataFrame, order: Sequence[str], group: Sequence[str] = ("user_id",)) -> DataFrame:
    """Add `state` to scoring results in call order: from the first daily-quota error of a group on
    everything is 'stopped' and left for the next run; earlier rows are 'evaluated' or 'failed'.

    `order` must be unique within a group. An empty `group` makes one stop end the whole run. The stop
    points are an aggregate of the daily-quota errors alone, joined back, so no group passes through one
    window; they are usually few, and AQE then broadcasts them. Give written results: they are read twice.
    """
    by = list(group) or ["_run"]
    rows = results if group else results.withColumn("_run", F.lit(0))
    at = F.struct(*order)
    daily = rows.filter(error_class(F.col("error")) == "daily_quota")
    stops = daily.groupBy(*by).agg(F.min(at).alias("_stop"))
    state = (
        F.when(at >= F.col("_stop"), F.lit("stopped"))
        .when(F.col("error").isNull(), F.lit("evaluated"))
        .otherwise(F.lit("failed"))
    )
    joined = rows.join(stops, by, "left")
    return joined.withColumn("state", state).select(*results.columns, "state")
