"""The single-user batch: one profile, one mail per posting, and the report tables."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import alerts, report, scoring, store, worklist
from ..schemas import LEGACY_EVALUATIONS, LEGACY_POSTINGS, POSTING_TEXT, RUN_HISTORY
from ..session import materialize
from ..sources import tables


def evaluate(
    new: DataFrame, stored: DataFrame, evaluations: DataFrame, profile_text: str, scorer: scoring.Scorer, run_at: Column
) -> tuple[DataFrame, DataFrame]:
    """Score new and left-over postings; returns the new evaluations snapshot and this run's results.

    One exhausted daily quota ends the whole run.
    """
    profile = profile_text.strip()
    if not profile:
        raise ValueError("the profile text is empty")
    todo = worklist.carry_over(new, stored, evaluations, [F.desc("scraped_at"), *map(F.col, POSTING_TEXT)])
    # Ids of one board: the prompt needs a source column, the store has none.
    rows = todo.withColumns({"profile_text": F.lit(profile), "source_id": F.lit("")})
    answers = scoring.score_with_attempts(rows, scorer, ["job_id"])
    results = scoring.apply_quota_stop(answers, ["job_id"], group=())
    fresh = results.filter("state = 'evaluated'").select(
        "job_id", "score", "summary", run_at.cast("timestamp").alias("evaluated_at"), F.lit(False).alias("email_sent")
    )
    return store.upsert(evaluations, fresh, ["job_id"], [F.desc("evaluated_at")]), results


def notify(
    evaluations: DataFrame, postings: DataFrame, threshold: int, product: str
) -> tuple[DataFrame, DataFrame]:
    """Mails for all unsent matches, also those of earlier runs, and the snapshot after sending them."""
    due = alerts.pending_alerts(evaluations, postings, threshold)
    return alerts.alert_messages(due, product), store.mark_sent(evaluations, due, ["job_id"])


def run_batch(
    spark: SparkSession,
    root: str,
    records: DataFrame,
    profile_text: str,
    scorer: scoring.Scorer,
    threshold: int,
    product: str,
    run_at: str,
    run: int,
) -> DataFrame:
    """The whole batch in order: insert, evaluate, send, log, report. Returns the mails, which the caller sends.

    Postings, evaluations and the run log live below `root`, a snapshot for each run of the first two. A run
    starts from the last complete snapshot of each before it, so that runs that failed or were skipped lose nothing.
    """
    at, began = F.lit(run_at).cast("timestamp"), time.monotonic()

    def table(name: str, number: int, schema: StructType) -> DataFrame:
        return tables.read_or_empty(spark, f"{root}/{name}/run={number}", schema)

    def write(df: DataFrame, name: str, schema: StructType) -> DataFrame:
        df.select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{root}/{name}/run={run}")
        return table(name, run, schema)

    def before(name: str, schema: StructType) -> DataFrame:
        found = [r for r in tables.complete_runs(spark, f"{root}/{name}") if r < run]
        return table(name, max(found, default=run - 1), schema)

    stored, earlier = before("postings", LEGACY_POSTINGS), before("evaluations", LEGACY_EVALUATIONS)
    order = [F.desc("scraped_at"), *map(F.col, POSTING_TEXT)]
    new = materialize(store.insert_if_absent(stored, records.select(*LEGACY_POSTINGS.fieldNames()), ["job_id"], order), "new")
    postings = write(stored.unionByName(new), "postings", LEGACY_POSTINGS)
    evaluations, results = evaluate(new, stored, earlier, profile_text, scorer, at)
    evaluations = materialize(evaluations.select(*LEGACY_EVALUATIONS.fieldNames()), "evaluated")
    mails, after = notify(evaluations, postings, threshold, product)
    mails = materialize(mails, "mails")
    after = write(after, "evaluations", LEGACY_EVALUATIONS)
    done = results.filter("state = 'evaluated'")
    row = report.run_summary(stored, new, done, mails, ["job_id"]).withColumns(
        {"run_at": at, "duration_s": F.lit(time.monotonic() - began), "status": F.lit("ok")}
    )
    row.select(*RUN_HISTORY.fieldNames()).write.mode("overwrite").parquet(f"{root}/run_history/run={run}")
    history = spark.read.schema(RUN_HISTORY).parquet(f"{root}/run_history")
    report_tables(postings, after, history, F.to_date(at), f"{root}/report")
    return mails


def report_tables(
    postings: DataFrame, evaluations: DataFrame, runs: DataFrame, as_of: Column, root: str
) -> None:
    """Write key figures, details and run history; each replaces the last report."""
    tables = {
        "kpis": report.report_kpis(postings, evaluations),
        "detail": report.report_detail(postings, evaluations, as_of),
        "history": report.history_view(report.latest_rows(runs, "run_at", "notes")),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{root}/{name}")
