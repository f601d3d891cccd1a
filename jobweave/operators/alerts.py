"""Pending alerts and per-user digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import mail_color
from ..functions.text import cut, or_default, plural, source_label
from .ranking import number_rows
from .store import EVALUATION_KEY, POSTING_KEY

# Texts for missing fields. The wording of subjects, greetings and lines below is fixed as well.
NOT_SPECIFIED = "Not specified"
UNTITLED = "Unknown Position"
UNTITLED_CARD = "Position Closed"


def pending_evaluations(evaluations: DataFrame, users: DataFrame, *user_columns: str) -> DataFrame:
    """Evaluations at or above the user's own threshold that were not sent, with `user_columns`. An
    unknown flag is not 'unsent'."""
    due = evaluations.filter(F.col("email_sent") == F.lit(False)).join(
        users.select("user_id", "score_threshold", *user_columns), "user_id"
    )
    return due.filter(F.col("score") >= F.col("score_threshold")).drop("score_threshold")


def pending_alerts(evaluations: DataFrame, postings: DataFrame, threshold: int) -> DataFrame:
    """Single-user store: unsent postings with a score at or above `threshold`, best first."""
    due = evaluations.filter((F.col("score") >= threshold) & (F.col("email_sent") == F.lit(False)))
    return due.join(postings, "job_id").orderBy(F.desc("score"), "job_id")


def alert_messages(alerts: DataFrame, product: str) -> DataFrame:
    """Subject and plain body of one mail per posting."""
    score = F.col("score").cast("string")
    title = F.coalesce("title", F.lit("New Job Match"))

    def field(label: str, name: str) -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(F.col(name), F.lit("N/A")), F.lit("\n"))

    subject = F.concat(F.lit(f"[{product}] Score "), score, F.lit("/10 — "), title)
    body = F.concat(
        F.lit(f"{product} Job Match — Score "), score, F.lit("/10\n\nTitle: "), title, F.lit("\n"),
        field("Location", "location"), field("Contract", "contract_type"), field("Deadline", "deadline"),
        F.lit("\nWhy it matches:\n"), F.coalesce("summary", F.lit("")),
        F.lit("\n\nApply here: "), F.coalesce("url", F.lit("")),
    )
    return alerts.select("job_id", "score", mail_color(F.col("score")).alias("color"), subject.alias("subject"), body.alias("body"))


def due_matches(evaluations: DataFrame, users: DataFrame, postings: DataFrame) -> DataFrame:
    """Pending evaluations whose posting is still in the user's subscribed sources."""
    chosen = evaluations.select(*EVALUATION_KEY, "score", "summary", "email_sent")
    return (
        pending_evaluations(chosen, users, "enabled_sources")
        .join(postings.select(*POSTING_KEY), list(POSTING_KEY))
        .filter(F.array_contains("enabled_sources", F.col("source_id")))
        .select(*EVALUATION_KEY, "score", "summary")
    )


def digest_lines(due: DataFrame, postings: DataFrame, labels: DataFrame, summary_chars: int | None = None) -> DataFrame:
    """One row per line of a digest, numbered by score within the user. `due` comes from `due_matches`.

    A digest of any length stays a set of rows: a mailer reads them in order of `line_no`. Texts of
    postings are joined after numbering, so that the sort does not move them. `short_summary` is the whole
    summary, or its first `summary_chars` characters and an ellipsis where it is longer.
    """
    ranked = number_rows(due, ["user_id"], [F.desc("score"), F.col("source_id"), F.col("job_id")], "line_no")
    label = source_label("label", "source_id")
    text = F.concat(
        F.lit("["), label, F.lit("] "), F.coalesce("title", F.lit("N/A")),
        F.lit(" — Score "), F.col("score").cast("string"), F.lit("/10"),
    )
    summary = F.coalesce("summary", F.lit(""))
    if summary_chars is not None:
        shortened = F.concat(cut(summary, summary_chars), F.lit("..."))
        summary = F.when(F.length(summary) > summary_chars, shortened).otherwise(summary)
    return (
        ranked.join(postings, [*POSTING_KEY])
        .join(labels.select("source_id", "label"), "source_id", "left")
        .select(
            "user_id",
            "line_no",
            "source_id",
            "job_id",
            "score",
            label.alias("source_label"),
            mail_color(F.col("score")).alias("color"),
            F.coalesce("title", F.lit(UNTITLED)).alias("title"),
            F.coalesce(F.nullif("title", F.lit("")), F.lit(UNTITLED_CARD)).alias("card_title"),
            or_default("location", NOT_SPECIFIED).alias("location"),
            or_default("contract_type", NOT_SPECIFIED).alias("contract_type"),
            or_default("deadline", NOT_SPECIFIED).alias("deadline"),
            F.coalesce("url", F.lit("#")).alias("url"),
            text.alias("headline"),
            summary.alias("short_summary"),
        )
    )


def _recipient() -> Column:
    return F.coalesce(F.nullif("notification_email", F.lit("")), F.nullif("email", F.lit("")))


def user_digests(due: DataFrame, users: DataFrame, labels: DataFrame, product: str) -> DataFrame:
    """Recipient, greeting and subject of each digest that has lines and a recipient.

    Lines are first counted per user and source; what is collected per user is the set of labels of
    that user's own subscriptions. The lines themselves are `digest_lines`.
    """
    per_source = (
        due.groupBy("user_id", "source_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("best"))
        .join(labels.select("source_id", "label"), "source_id", "left")
    )
    per_user = per_source.groupBy("user_id").agg(
        F.sum("n").alias("n_matches"),
        F.max("best").alias("best_score"),
        F.array_join(F.array_sort(F.collect_set(source_label("label", "source_id"))), ", ").alias("source_labels"),
    )
    n = F.col("n_matches")
    shown = F.concat(n.cast("string"), F.lit(" job "), plural(n, "match", "es"), F.lit(" — "), F.col("source_labels"))
    name = F.coalesce(F.nullif("name", F.lit("")), F.col("email"), F.lit("there"))
    greeting = F.concat(
        F.lit("Hi "), name, F.lit(" — "), n.cast("string"), F.lit(" new "), plural(n, "match", "es"),
        F.lit(" from "), F.col("source_labels"),
    )
    return (
        per_user.join(users.select("user_id", "name", "email", "notification_email"), "user_id")
        .select(
            "user_id",
            _recipient().alias("recipient"),
            F.concat(F.lit(f"[{product}] "), shown).alias("subject"),
            greeting.alias("greeting"),
            "n_matches",
            "best_score",
            "source_labels",
        )
        .filter(F.col("recipient").isNotNull())
    )


def delivered_keys(due: DataFrame, users: DataFrame, pending: DataFrame | None = None) -> DataFrame:
    """Evaluations to mark as sent: the delivered lines, or every row of `pending`
    (`pending_evaluations`) of a user who got a digest."""
    reachable = users.filter(_recipient().isNotNull()).select("user_id")
    delivered = due.select(*EVALUATION_KEY).join(reachable, "user_id", "left_semi")
    if pending is None:
        return delivered.distinct()
    served = delivered.select("user_id").distinct()
    return pending.join(served, "user_id", "left_semi").select(*EVALUATION_KEY)
