"""Accounts as the matching jobs see them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import DEFAULT_THRESHOLD
from ..functions.text import is_blank, strip


def with_defaults(users: DataFrame, default_sources: Sequence[str]) -> DataFrame:
    """Fill a missing threshold and a missing source list; an empty list stays empty."""
    sources = F.array(*[F.lit(s) for s in default_sources]).cast("array<string>")
    return users.withColumns(
        {
            "score_threshold": F.coalesce("score_threshold", F.lit(DEFAULT_THRESHOLD)),
            "enabled_sources": F.coalesce("enabled_sources", sources),
        }
    )


def active_users(users: DataFrame, default_sources: Sequence[str]) -> DataFrame:
    return with_defaults(users.filter("verified"), default_sources)


def scorable(users: DataFrame) -> DataFrame:
    """Users with their stripped profile and the reason why they cannot be scored, if any."""
    reason = F.when(is_blank("profile_text"), F.lit("no profile text"))
    return users.withColumn("reject_reason", reason).withColumn(
        "profile_text", strip(F.coalesce("profile_text", F.lit("")))
    )


def effective_sources(requested: Column, enabled: Column) -> Column:
    """The requested source alone when the user has enabled it, else all enabled sources."""
    usable = F.coalesce(requested != "", F.lit(False)) & F.array_contains(enabled, requested)
    return F.when(usable, F.array(requested)).otherwise(enabled)


def subscriptions(users: DataFrame, sources: str = "enabled_sources", *carry: str) -> DataFrame:
    """One row per user and distinct source, with the `carry` columns of the user."""
    return users.select("user_id", *carry, F.explode(F.array_distinct(sources)).alias("source_id"))
