"""Report tables: details, key figures, run history and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import contract_class, deadline_columns, deadline_date, report_band
from ..functions.text import duration_text
from .ranking import number_rows

TOP_SCORE = 9  # fixed value: lower bound of the "excellent" count
HISTORY_ROWS = 20  # fixed value: runs shown

# Typed sort expressions of the report's columns; text sorts by the collation of a locale.
LOCALE = "en"


def _in_locale(column: str, locale: str) -> Column:
    """A text as a reader of the locale sorts it: accents and case decide only among equal letters. No text is empty."""
    return F.collate(F.coalesce(column, F.lit("")), locale)


SORT_KEYS = {
    "title": lambda locale: _in_locale("title", locale),
    "job_id": lambda locale: F.col("job_id"),
    "location": lambda locale: _in_locale("location", locale),
    "contract_type": lambda locale: _in_locale("contract_type", locale),
    "deadline": lambda locale: deadline_date(F.col("deadline")),
    "score": lambda locale: F.col("score_key"),
    "email_sent": lambda locale: F.col("sent_key"),
}


def report_detail(postings: DataFrame, evaluations: DataFrame, as_of: Column) -> DataFrame:
    """Every posting with its evaluation, if any, and the report's sort and display columns.

    Best score first, unevaluated last. A global sort is a range partitioning, so equal scores spread
    over partitions by job id.
    """
    score = F.col("score")
    deadline = deadline_columns(F.col("deadline"), as_of)
    sent_key = (
        F.when(score.isNull(), -1).when(F.coalesce("email_sent", F.lit(False)), 1).otherwise(0)
    )
    return (
        postings.join(evaluations, "job_id", "left")
        .withColumns(
            {
                "score_key": F.coalesce(score, F.lit(-1)),
                "sent_key": sent_key,
                "score_band": report_band(score),
                "contract_class": F.when(score.isNotNull(), contract_class(F.col("contract_type"))),
                **deadline,
            }
        )
        .orderBy(F.desc("score_key"), "job_id")
    )


def report_kpis(postings: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Totals over all postings in one aggregation; the average is null when nothing is scored."""
    joined = postings.select("job_id").join(evaluations.select("job_id", "score", "email_sent"), "job_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("score").alias("evaluated"),
        F.count_if("email_sent").alias("sent"),
        F.round(F.avg("score"), 6).alias("avg_score"),
        F.count_if(F.col("score") >= TOP_SCORE).alias("n_top"),
    )


def sort_order(column: str, ascending: bool = True, locale: str = LOCALE) -> list[Column]:
    """The viewer's order by a column, texts by the collation of their locale; ties and unparsable values keep the job
    id's order."""
    key = SORT_KEYS[column](locale)
    return [key.asc_nulls_last() if ascending else key.desc_nulls_last(), F.col("job_id")]


def report_sorted(detail: DataFrame, column: str, ascending: bool = True, locale: str = LOCALE) -> DataFrame:
    """The report in the viewer's order."""
    return detail.orderBy(*sort_order(column, ascending, locale))


def report_numbered(detail: DataFrame, column: str, ascending: bool = True, locale: str = LOCALE) -> DataFrame:
    """The report with each row's position in the viewer's order, counted over range partitions."""
    return number_rows(detail, [], sort_order(column, ascending, locale))


def audit_counts(postings: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Row counts of both tables, in one aggregation over their union."""
    rows = postings.select(
        F.lit("job").alias("kind"), F.lit(None).cast("int").alias("score"), F.lit(None).cast("boolean").alias("email_sent")
    ).unionByName(evaluations.select(F.lit("evaluation").alias("kind"), "score", "email_sent"))
    return rows.agg(
        F.count_if(F.col("kind") == "job").alias("n_jobs"),
        F.count_if(F.col("kind") == "evaluation").alias("n_evaluations"),
        F.count_if(F.col("score") > 0).alias("n_scored"),
        F.count_if("email_sent").alias("n_sent"),
    )


def audit_listing(evaluations: DataFrame) -> DataFrame:
    return evaluations.select("job_id", "score", "email_sent", "evaluated_at").orderBy(
        F.desc_nulls_last("score"), "job_id"
    )


def latest_rows(table: DataFrame, time: str, tie: str, n: int = HISTORY_ROWS) -> DataFrame:
    """The `n` newest rows: a top-k, not a sort of the table."""
    return table.orderBy(F.desc(time), tie).limit(n)


def history_view(runs: DataFrame) -> DataFrame:
    """Display texts of the run history."""
    new_jobs = F.coalesce("new_jobs", F.lit(0))
    return runs.select(
        F.date_format("run_at", "yyyy-MM-dd HH:mm").alias("run_at_text"),
        F.when(F.coalesce("trigger", F.lit("scheduled")) == "manual", "manual").otherwise("scheduled").alias("trigger_text"),
        "jobs_in_db",
        F.when(new_jobs > 0, F.concat(F.lit("+"), new_jobs.cast("string"), F.lit(" new"))).otherwise("none").alias("new_text"),
        "evaluated",
        "emails_sent",
        duration_text("duration_s").alias("duration_text"),
        F.when(F.coalesce("status", F.lit("ok")) == "ok", "ok").otherwise("error").alias("status_text"),
        "notes",
    )


def best_match(evaluated: DataFrame, *order: str) -> DataFrame:
    """Highest positive score of a run; the first in `order` wins ties."""
    return (
        evaluated.filter("score > 0")
        .agg(F.min_by(F.struct("job_id", "score"), F.struct(-F.col("score"), *order)).alias("best"))
        .select(F.col("best.job_id").alias("best_job_id"), F.col("best.score").alias("best_score"))
    )


def run_summary(
    known: DataFrame,
    new: DataFrame,
    evaluated: DataFrame,
    sent: DataFrame,
    order: list[str],
    manual: bool = False,
) -> DataFrame:
    """One row of run figures and its note. `evaluated` has job_id, score and the order columns; `sent`
    one row per message."""

    def rows(table: DataFrame, kind: str) -> DataFrame:
        # Only evaluations carry the columns that decide the best match.
        chosen = dict.fromkeys(["job_id", "score", *order]) if kind == "evaluated" else []
        return table.select(F.lit(kind).alias("kind"), *chosen)

    parts = rows(evaluated, "evaluated")
    for table, kind in ((known, "known"), (new, "new"), (sent, "sent")):
        parts = parts.unionByName(rows(table, kind), allowMissingColumns=True)
    rank = F.when(F.col("score") > 0, F.struct(-F.col("score"), *order))
    figures = parts.agg(
        F.count_if(F.col("kind").isin("known", "new")).alias("jobs_in_db"),
        F.count_if(F.col("kind") == "new").alias("new_jobs"),
        F.count_if(F.col("kind") == "evaluated").alias("evaluated"),
        F.count_if(F.col("kind") == "sent").alias("emails_sent"),
        F.min_by("job_id", rank).alias("best_job_id"),
        F.max(F.when(F.col("score") > 0, F.col("score"))).alias("best_score"),
    )
    count = F.col("new_jobs").cast("string")
    notes = (
        F.when(F.col("new_jobs") == 0, F.lit(""))
        .when(
            F.col("best_score").isNotNull(),
            F.concat(
                count, F.lit(" new job(s); best: "), F.col("best_job_id"), F.lit(" ("),
                F.col("best_score").cast("string"), F.lit("/10)"),
            ),
        )
        .otherwise(F.concat(count, F.lit(" new job(s) found")))
    )
    return figures.withColumn("trigger", F.lit("manual" if manual else "scheduled")).withColumn("notes", notes)
