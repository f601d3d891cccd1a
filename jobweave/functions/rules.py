"""Validation rules of account requests, as columns of violated rule names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted bounds and the e-mail form.
NAME_LENGTH = (1, 120)
PROFILE_LENGTH = (20, 10_000)
THRESHOLD_RANGE = (1, 10)
EMAIL_PATTERN = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"

DEFAULT_THRESHOLD = 7


def _violated(rule: Column, name: str) -> Column:
    """`name` where the rule is broken; an unknown outcome breaks it."""
    return F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))


def _reasons(*violations: Column) -> Column:
    return F.array_compact(F.array(*violations))


def registration_reasons(threshold: Column) -> Column:
    """Rules broken by a registration; `threshold` already carries its default."""
    return _reasons(
        _violated(F.col("email").rlike(EMAIL_PATTERN), "email"),
        _violated(F.length("name").between(*NAME_LENGTH), "name"),
        _violated(F.length("profile_text").between(*PROFILE_LENGTH), "profile_text"),
        _violated(threshold.between(*THRESHOLD_RANGE), "score_threshold"),
    )


def update_reasons(unknown: Column) -> Column:
    """Rules broken by a partial update. A field left out (null) breaks none; `unknown` holds the
    requested sources that do not exist."""

    def when_given(field: str, rule: Column, name: str) -> Column:
        return F.when(F.col(field).isNotNull(), _violated(rule, name))

    return _reasons(
        when_given("name", F.length("name") <= NAME_LENGTH[1], "name"),
        when_given("profile_text", F.length("profile_text").between(*PROFILE_LENGTH), "profile_text"),
        when_given("score_threshold", F.col("score_threshold").between(*THRESHOLD_RANGE), "score_threshold"),
        F.when(F.size(unknown) > 0, F.lit("enabled_sources")),
    )
