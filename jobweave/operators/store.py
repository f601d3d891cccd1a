"""Table mutations as pure plans: each returns the rows of the new state and writes nothing.

Plain Parquet has no in-place update, so a caller writes the returned rows to a new snapshot
(`sources.tables.write_snapshot`) or, for inserts, appends them. Calling only the plan is a dry run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import first_per_group

POSTING_KEY = ("source_id", "job_id")
# Two boards may use the same job id, so an evaluation names its board.
EVALUATION_KEY = ("user_id", *POSTING_KEY)


def known_ids(postings: DataFrame) -> DataFrame:
    return postings.select(*POSTING_KEY).distinct()


def postings_of_sources(postings: DataFrame, source_ids: Sequence[str]) -> DataFrame:
    """Postings of the listed sources; none for an empty list. Prunes partitions by source."""
    if not source_ids:
        return postings.filter(F.lit(False))
    return postings.filter(F.col("source_id").isin(*source_ids))


def insert_if_absent(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Rows of `batch` to append: first row per key in `order`, keys not stored yet."""
    return first_per_group(batch, key, order).join(existing.select(*key), list(key), "left_anti")


def upsert(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """New snapshot: the first row per key of `batch` in `order` (newest first for last write wins)
    replaces the stored row as a whole."""
    replaced = batch.select(*key).distinct()
    kept = existing.join(replaced, list(key), "left_anti")
    return kept.unionByName(first_per_group(batch, key, order).select(*existing.columns))


def with_user_id(users: DataFrame) -> DataFrame:
    """Fill a missing account id from `user_id`, then from the e-mail address."""
    return users.withColumn("id", F.coalesce("id", "user_id", "email", F.lit("")))


def mark_sent(evaluations: DataFrame, sent: DataFrame, key: Sequence[str] = EVALUATION_KEY) -> DataFrame:
    """New snapshot with `email_sent` set for the keys in `sent`; unknown keys change nothing."""
    keys = sent.select(*key).distinct().withColumn("_sent", F.lit(True))
    flag = F.when(F.col("_sent"), F.lit(True)).otherwise(F.col("email_sent"))
    return (
        evaluations.join(keys, list(key), "left")
        .withColumn("email_sent", flag)
        .select(*evaluations.columns)
    )


def cleared(evaluations: DataFrame) -> DataFrame:
    """New, empty snapshot of the evaluations; postings are not touched."""
    return evaluations.filter(F.lit(False))


def cleared_count(evaluations: DataFrame) -> DataFrame:
    return evaluations.agg(F.count(F.lit(1)).alias("n_cleared"))


def lookup_users(keys: DataFrame, users: DataFrame, by: str, order: Sequence[Column]) -> DataFrame:
    """For each key the first matching user, or nulls. `keys` has one column named `by`."""
    wanted = keys.select(by).filter(F.col(by).isNotNull()).distinct()
    firsts = first_per_group(users.join(wanted, by, "left_semi"), [by], order)
    return keys.join(firsts, by, "left")


def latest_evaluations(
    log: DataFrame, order: Sequence[Column], key: Sequence[str] = EVALUATION_KEY
) -> DataFrame:
    """Last write wins: `order` lists the newest row first."""
    return first_per_group(log, key, order)
