"""What is new, and what still needs a score.

Users times postings is the largest relation here. Everything that only counts it works on
users x sources and on the evaluations, which are both linear in the input; only `worklist` itself
enumerates pairs, because each of its rows stands for one call of a scorer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import first_per_group
from .store import EVALUATION_KEY, POSTING_KEY
from .tiles import tiled
from .users import subscriptions

# A tile has up to TILE_ROWS users and as many postings.
TILE_ROWS = 512
PAIRS_PER_TASK = 500_000


def new_postings(batch: DataFrame, stored: DataFrame, order: list[Column]) -> DataFrame:
    """Records of a batch whose key is not stored yet, one per key."""
    unseen = batch.join(stored.select(*POSTING_KEY), list(POSTING_KEY), "left_anti")
    return first_per_group(unseen, POSTING_KEY, order)


def seen_flags(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct keys of a batch, each with whether it is stored already."""
    known = stored.select(*POSTING_KEY).distinct().withColumn("_known", F.lit(True))
    return (
        batch.select(*POSTING_KEY)
        .distinct()
        .join(known, list(POSTING_KEY), "left")
        .select(*POSTING_KEY, F.coalesce("_known", F.lit(False)).alias("seen"))
    )


def settled_evaluations(evaluations: DataFrame, retry_failed: bool) -> DataFrame:
    """Evaluations that need no further attempt. With `retry_failed` a score of 0 is a failed attempt;
    a missing score is not."""
    return evaluations.filter("score IS NULL OR score <> 0") if retry_failed else evaluations


def unevaluated_postings(postings: DataFrame, evaluations: DataFrame, retry_failed: bool = True) -> DataFrame:
    """Single-user store: postings without evaluation or with a failed one."""
    settled = settled_evaluations(evaluations, retry_failed).select("job_id")
    return postings.join(settled, "job_id", "left_anti")


def carry_over(
    new: DataFrame, stored: DataFrame, evaluations: DataFrame, order: list[Column]
) -> DataFrame:
    """Postings to evaluate in a run: the new ones and stored ones left over from earlier runs."""
    pending = unevaluated_postings(new.unionByName(stored), evaluations)
    return first_per_group(pending, ["job_id"], order)


def candidate_counts(users: DataFrame, postings: DataFrame) -> DataFrame:
    """Postings each user could be shown, per subscribed source, without listing them."""
    per_source = postings.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_postings"))
    return subscriptions(users).join(per_source, "source_id").select("user_id", "source_id", "n_postings")


def evaluated_candidates(
    users: DataFrame, postings: DataFrame, evaluations: DataFrame, block: Sequence[str] = ()
) -> DataFrame:
    """Evaluations of postings in the user's subscribed sources. Linear in the evaluations."""
    return evaluations.join(postings.select(*POSTING_KEY, *block), list(POSTING_KEY)).join(
        subscriptions(users), ["user_id", "source_id"], "left_semi"
    )


def worklist_counts(
    users: DataFrame, postings: DataFrame, evaluations: DataFrame, retry_failed: bool = False
) -> DataFrame:
    """Per user: candidates, those already settled, those still to score, and all settled evaluations."""
    settled = settled_evaluations(evaluations, retry_failed).select(*EVALUATION_KEY)
    candidates = candidate_counts(users, postings).groupBy("user_id").agg(F.sum("n_postings").alias("n_candidates"))
    done = (
        evaluated_candidates(users, postings, settled)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n_done"))
    )
    skipped = settled.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_evaluated"))

    def zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0))

    return (
        users.select("user_id")
        .join(candidates, "user_id", "left")
        .join(done, "user_id", "left")
        .join(skipped, "user_id", "left")
        .select(
            "user_id",
            zero("n_candidates").alias("n_candidates"),
            zero("n_evaluated").alias("n_evaluated"),
            (zero("n_candidates") - zero("n_done")).alias("n_todo"),
        )
    )


def open_blocks(
    users: DataFrame, postings: DataFrame, settled: DataFrame, block: Sequence[str] = ()
) -> DataFrame:
    """Subscribed blocks of postings a user has not settled completely: `n_done` and `n_todo` each.

    A block is a source, or a source and further columns such as the run that collected the posting.
    Linear in subscriptions x blocks and in the evaluations.
    """
    by = ["source_id", *block]
    sizes = postings.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    done = (
        evaluated_candidates(users, postings, settled.select(*EVALUATION_KEY), block)
        .groupBy("user_id", *by)
        .agg(F.count(F.lit(1)).alias("_done"))
    )
    n_done = F.coalesce("_done", F.lit(0))
    return (
        subscriptions(users)
        .join(sizes, "source_id")
        .join(done, ["user_id", *by], "left")
        .select("user_id", *by, n_done.alias("n_done"), (F.col("_size") - n_done).alias("n_todo"))
        .filter("n_todo > 0")
    )


def worklist_by_source(
    users: DataFrame, postings: DataFrame, evaluations: DataFrame, retry_failed: bool = False
) -> DataFrame:
    """The open worklist per user and source, without listing its pairs."""
    settled = settled_evaluations(evaluations, retry_failed)
    return open_blocks(users, postings, settled).select("user_id", "source_id", "n_todo")


def worklist(
    users: DataFrame,
    postings: DataFrame,
    evaluations: DataFrame,
    retry_failed: bool = False,
    block: Sequence[str] = (),
    user_columns: Sequence[str] = (),
) -> DataFrame:
    """The (user, posting) pairs to score: the posting's columns with the user's id and `user_columns`.

    Only pairs of open blocks are listed, so with the collecting run as block a new run costs its own
    pairs and not the history's. A block nobody has touched needs no comparison with the evaluations,
    and its pairs leave the join without another shuffle; pairs of blocks done in part are compared by
    key. Pairs are listed tile by tile, in a number of tasks that follows from their counted number: a
    source that holds a large share of postings or users gives many tiles of ordinary size, and AQE does
    not merge tasks whose small inputs hide a large output.
    """
    settled = settled_evaluations(evaluations, retry_failed).select(*EVALUATION_KEY)
    by = ["source_id", *block]
    todo = materialize(open_blocks(users, postings, settled, block), "open-blocks")
    n_pairs = todo.agg(F.sum("n_todo")).first()[0] or 0
    n_tasks = max(1, math.ceil(n_pairs / PAIRS_PER_TASK))
    seekers = todo.select("user_id", *by, (F.col("n_done") > 0).alias("_touched")).join(
        users.select("user_id", *user_columns), "user_id"
    )

    def listed(who: DataFrame, what: DataFrame) -> DataFrame:
        left, right, tile = tiled(who.drop("_touched"), what, by, "user_id", "job_id", TILE_ROWS)
        return left.repartition(n_tasks, *tile).join(right.repartition(n_tasks, *tile), tile).drop("left_tile", "right_tile")

    fresh = listed(seekers.filter(~F.col("_touched")), postings)
    partial = (
        listed(seekers.filter("_touched"), postings.select(*by, "job_id"))
        .join(settled, list(EVALUATION_KEY), "left_anti")
        .join(postings, [*by, "job_id"])
    )
    return fresh.unionByName(partial)


def shortlisted_worklist(
    nearest: DataFrame,
    users: DataFrame,
    postings: DataFrame,
    evaluations: DataFrame,
    retry_failed: bool = False,
    user_columns: Sequence[str] = (),
) -> DataFrame:
    """As `worklist`, for the pairs of a shortlist (`shortlist.shortlist`) only. Linear in the shortlist
    and the evaluations."""
    settled = settled_evaluations(evaluations, retry_failed).select(*EVALUATION_KEY)
    return (
        nearest.select("user_id", *POSTING_KEY)
        .join(settled, list(EVALUATION_KEY), "left_anti")
        .join(postings, list(POSTING_KEY))
        .join(users.select("user_id", *user_columns), "user_id")
    )
