"""The same posting on several boards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def content_key(text: Column) -> Column:
    """Digest of the whole text without regard to case and spacing."""
    return F.md5(strip(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " ")))


def cross_source_groups(postings: DataFrame, text: Column) -> DataFrame:
    """Texts that appear on two or more boards: the kept posting, the copies and the boards.

    Only counts and minima are aggregated, with a partial step before the shuffle; copies are neither
    collected nor paired, so a text with a third of all rows costs one row per task and board.
    """
    keyed = postings.select(content_key(text).alias("content_key"), "source_id", "job_id")
    per_board = keyed.groupBy("content_key", "source_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("job_id").alias("job_id")
    )
    return (
        per_board.groupBy("content_key")
        .agg(
            F.min(F.struct("source_id", "job_id")).alias("kept"),
            F.sum("n").alias("n_copies"),
            F.count(F.lit(1)).alias("n_boards"),
        )
        .filter("n_boards > 1")
        .select("content_key", "kept.source_id", "kept.job_id", "n_copies", "n_boards")
    )
