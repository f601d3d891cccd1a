"""The multi-user batch cycle: ingest, evaluate, notify.

Each phase writes its rows before the next one reads them, and every table only grows: a run appends
its own folder and no stored row is rewritten. A run that is repeated after a failure replaces the
folders of its own number.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators import alerts, scoring, store, worklist
from ..operators import users as people
from ..operators.report import run_summary
from ..schemas import EVALUATIONS, POSTINGS, RUN_HISTORY
from ..session import materialize
from ..sources import ingest, registry
from ..sources.tables import complete_runs

DELIVERIES = StructType([StructField(name, StringType()) for name in store.EVALUATION_KEY])
# A shortlist (user_id, source_id, job_id), or a function that makes one of the stored postings.
Nearest = DataFrame | Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RunTables:
    """Append-only tables below `root`, one folder per run.

    Set `rescored` where runs score failed pairs again: a pair then has several evaluations, and the
    last one is looked up. Otherwise the worklist keeps (user, board, posting) unique and that shuffle is saved.
    """

    spark: SparkSession
    root: str
    rescored: bool = False

    def write(self, df: DataFrame, name: str, run: int, partition_by: Sequence[str] = ()) -> None:
        if partition_by:
            # AQE splits a value that holds a large share of the rows over several tasks.
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*partition_by).parquet(f"{self.root}/{name}/run={run}")

    def read(self, name: str, schema: StructType) -> DataFrame:
        """Rows of all runs with their `run`; filters on it prune folders."""
        fields = StructType([*schema.fields, StructField("run", LongType())])
        try:
            return self.spark.read.schema(fields).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], fields)

    def drop(self, name: str, run: int) -> None:
        """Delete the rows of one run, if there are any."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/run={run}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def of_run(self, name: str, run: int) -> DataFrame:
        """What a run has just written."""
        return self.spark.read.parquet(f"{self.root}/{name}/run={run}")

    def postings(self, until: int) -> DataFrame:
        return self.read("postings", POSTINGS).filter(F.col("run") <= until)

    def scores(self, until: int) -> DataFrame:
        """The last evaluation per pair, as scored; `deliveries` tells what was sent since."""
        rows = self.read("evaluations", EVALUATIONS).filter(F.col("run") <= until)
        return store.latest_evaluations(rows, [F.desc("run"), F.desc("evaluated_at")]) if self.rescored else rows

    def deliveries(self, until: int) -> DataFrame:
        return self.read("deliveries", DELIVERIES).filter(F.col("run") <= until)

    def waiting(self, run: int) -> DataFrame:
        """Unsent evaluations: those of this run, and the ones earlier runs have left.

        They are carried on from the last earlier run whose pending rows are complete. Runs between, which failed or
        have no number, add their evaluations less their deliveries; where no run has complete pending
        rows, that is the whole history.
        """
        last = max((r for r in complete_runs(self.spark, f"{self.root}/pending") if r < run), default=None)
        later = F.lit(True) if last is None else F.col("run") > last
        new = self.read("evaluations", EVALUATIONS).filter((F.col("run") <= run) & later)
        if last is None:
            old = self.spark.createDataFrame([], EVALUATIONS)
        else:
            old = self.read("pending", EVALUATIONS).filter(F.col("run") == last).drop("run")
        if self.rescored:  # a pair scored again replaces what was left of it
            rows = store.upsert(old, new, store.EVALUATION_KEY, [F.desc("run"), F.desc("evaluated_at")])
        else:
            rows = old.unionByName(new.drop("run"))
        if last == run - 1:
            return rows
        return rows.join(self.deliveries(run - 1).filter(later).drop("run"), list(store.EVALUATION_KEY), "left_anti")

    def evaluations(self, until: int) -> DataFrame:
        """The last evaluation per pair, marked sent once it was delivered."""
        return store.mark_sent(self.scores(until), self.deliveries(until))


def ingest_run(
    tables: RunTables,
    run: int,
    configs: Mapping[str, Mapping[str, object]],
    loaders: Mapping[str, ingest.Loader],
    run_at: Column,
) -> DataFrame:
    """Append the postings never seen before; returns one status row per board."""
    records, status = ingest.ingest_sources(tables.spark, configs, loaders, run_at)
    last_first = [F.desc("scraped_at"), *[F.desc(c) for c in POSTINGS.fieldNames() if c != "scraped_at"]]
    fresh = worklist.new_postings(records, tables.postings(run - 1), last_first)
    tables.write(fresh.select(*POSTINGS.fieldNames()), "postings", run, ["source_id"])
    return status


def evaluate_run(
    tables: RunTables,
    run: int,
    users: DataFrame,
    scorer: scoring.Scorer,
    default_sources: Sequence[str],
    run_at: Column,
    nearest: Nearest | None = None,
    all_pairs: bool = False,
) -> DataFrame:
    """Score the open pairs of a shortlist and append the evaluations; returns all results with their state.

    `nearest` is a shortlist, or a function that makes one of the stored postings. Every open (user, posting)
    pair is listed only where `all_pairs` asks for it: their number grows with the product of both.
    """
    if (nearest is None) != all_pairs:
        raise ValueError("give a shortlist in `nearest`, or ask for all pairs")
    able = people.scorable(people.active_users(users, default_sources)).filter("reject_reason IS NULL")
    postings, scores, carry = tables.postings(run), tables.scores(run - 1), ["profile_text"]
    if nearest is None:
        pairs = worklist.worklist(able, postings, scores, tables.rescored, block=["run"], user_columns=carry)
    else:
        chosen = nearest(postings) if callable(nearest) else nearest
        pairs = worklist.shortlisted_worklist(chosen, able, postings, scores, tables.rescored, carry)

    def rebuild(keys: DataFrame) -> DataFrame:
        whose = keys.join(able.select("user_id", *carry), "user_id")
        return whose.join(postings.drop("run"), list(store.POSTING_KEY)).select(pairs.drop("run").columns)

    answers = scoring.score_with_attempts(pairs.drop("run"), scorer, list(store.EVALUATION_KEY), rebuild=rebuild)
    results = scoring.apply_quota_stop(answers, ["source_id", "job_id"])
    evaluated = results.filter("state = 'evaluated'").withColumns(
        {"email_sent": F.lit(False), "evaluated_at": run_at.cast("string")}
    )
    tables.drop("pending", run)  # of an earlier attempt: it belongs to the evaluations that are replaced now
    tables.write(evaluated.select(*EVALUATIONS.fieldNames()), "evaluations", run)
    return results


def notify_run(
    tables: RunTables,
    run: int,
    users: DataFrame,
    sources: DataFrame,
    default_sources: Sequence[str],
    product: str,
) -> tuple[DataFrame, DataFrame]:
    """Write this run's digests, their lines, the delivered keys and what stays pending; returns digests and
    lines.

    Read are this run's evaluations and those the last complete run has left pending, whether below a threshold or
    without address, and no older ones; see `RunTables.waiting` for runs that failed since. Deliveries and pending
    rows are written last: a run that fails before leaves its matches to the next run, whatever its number.
    """
    active = people.active_users(users, default_sources)
    postings = tables.postings(run).drop("run")
    labels = registry.source_labels(sources)
    waiting = tables.waiting(run)
    due = materialize(alerts.due_matches(waiting, active, postings), "due")
    tables.write(alerts.user_digests(due, active, labels, product), "digests", run)
    digests = tables.of_run("digests", run)
    # Users without any address have no digest; their matches stay pending.
    served = due.join(digests.select("user_id"), "user_id", "left_semi")
    tables.write(alerts.digest_lines(served, postings, labels), "digest_lines", run)
    tables.write(served.select(*store.EVALUATION_KEY), "deliveries", run)
    left = waiting.join(tables.of_run("deliveries", run), list(store.EVALUATION_KEY), "left_anti")
    tables.write(left.select(*EVALUATIONS.fieldNames()), "pending", run)
    return digests, tables.of_run("digest_lines", run)


def log_run(tables: RunTables, run: int, run_at: Column, duration_s: float | None, manual: bool = False, status: str = "ok") -> None:
    """Append the run's figures, counted from what it wrote."""
    figures = run_summary(
        tables.postings(run - 1),
        tables.postings(run).filter(F.col("run") == run),
        tables.read("evaluations", EVALUATIONS).filter(F.col("run") == run),
        tables.of_run("digests", run),
        ["user_id", "source_id", "job_id"],
        manual,
    )
    row = figures.withColumns(
        {"run_at": run_at.cast("timestamp"), "duration_s": F.lit(duration_s).cast("double"), "status": F.lit(status)}
    )
    tables.write(row.select(*RUN_HISTORY.fieldNames()), "run_history", run)


def run_cycle(
    tables: RunTables,
    run: int,
    configs: Mapping[str, Mapping[str, object]],
    loaders: Mapping[str, ingest.Loader],
    users: DataFrame,
    sources: DataFrame,
    scorer: scoring.Scorer,
    default_sources: Sequence[str],
    product: str,
    run_at: str,
    nearest: Nearest | None = None,
    all_pairs: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """One whole cycle; returns this run's digests and digest lines. Its log row holds the measured duration."""
    at, began = F.lit(run_at), time.monotonic()
    ingest_run(tables, run, configs, loaders, at)
    evaluate_run(tables, run, users, scorer, default_sources, at, nearest, all_pairs)
    sent = notify_run(tables, run, users, sources, default_sources, product)
    log_run(tables, run, at, time.monotonic() - began)
    return sent
