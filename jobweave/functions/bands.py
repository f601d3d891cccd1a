"""Classification of scores, deadlines and contracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound of each band, best band first.
REPORT_BANDS = ((9, "excellent"), (7, "good"), (None, "low"))
MAIL_BANDS = ((9, "#2e7d32"), (7, "#1565c0"), (5, "#e65100"), (None, "#b71c1c"))
DASHBOARD_BANDS = ((8, "high"), (5, "mid"), (None, "low"))
MEANING_BANDS = ((9, "Excellent match"), (7, "Good match"), (5, "Partial match"), (3, "Weak match"), (None, "Poor match"))

# Contract names per class, compared in lower case.
STAFF_CONTRACTS = ("staff", "permanent")
SHORT_TERM_CONTRACTS = ("short-term",)

SOON_DAYS = 7


def band(score: Column, bands, unscored: str | None = None) -> Column:
    """Name of the first band whose lower bound the score reaches."""
    expr = F.when(score.isNull(), F.lit(unscored).cast("string"))
    for bound, name in bands:
        if bound is None:
            return expr.otherwise(F.lit(name))
        expr = expr.when(score >= bound, F.lit(name))
    return expr


def report_band(score: Column) -> Column:
    return band(score, REPORT_BANDS, "unevaluated")


def mail_color(score: Column) -> Column:
    # A score above 10 is outside every range and falls to the last colour.
    return F.when(score > 10, F.lit(MAIL_BANDS[-1][1])).otherwise(band(score, MAIL_BANDS))


def dashboard_band(score: Column) -> Column:
    return band(score, DASHBOARD_BANDS, "pending")


def dashboard_label(score: Column) -> Column:
    return F.when(score.isNull(), F.lit("Pending")).otherwise(F.concat(score.cast("string"), F.lit("/10")))


def score_meaning(score: Column) -> Column:
    return band(score, MEANING_BANDS)


def contract_class(contract: Column) -> Column:
    lowered = F.lower(F.coalesce(contract, F.lit("")))
    return (
        F.when(lowered.isin(*STAFF_CONTRACTS), F.lit("staff"))
        .when(lowered.isin(*SHORT_TERM_CONTRACTS), F.lit("short-term"))
        .otherwise(F.lit("other"))
    )


def deadline_date(deadline: Column) -> Column:
    """Date in the first ten characters, one- or two-digit month and day; null where it is none."""
    return F.try_to_timestamp(F.substring(deadline, 1, 10), F.lit("yyyy-M-d")).cast("date")


def deadline_columns(deadline: Column, as_of: Column) -> dict[str, Column]:
    """Shown text and flags of a deadline. A past deadline is also `soon`; `expired` tells them apart."""
    day = deadline_date(deadline)
    days_left = F.datediff(day, as_of)
    head = F.substring(deadline, 1, 10)
    return {
        "deadline_text": F.when(F.coalesce(deadline, F.lit("")) == "", F.lit("—")).otherwise(head),
        "days_left": days_left,
        "is_soon": F.coalesce(days_left <= SOON_DAYS, F.lit(False)),
        "is_expired": F.coalesce(days_left < 0, F.lit(False)),
    }
