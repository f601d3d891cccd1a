"""The best postings of each user by tag overlap, without listing what cannot be among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import top_per_group
from .tiles import tiled

TOP_K = 10
TILE_ROWS = 512


def _job_sets(tagged: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct tag sets of the postings by tag (tag, n: postings with the tag, job_tags, head: one of the tag's first
    `k` postings has the set), and the first `k` postings of every set."""
    order = [F.col("source_id"), F.col("job_id")]
    sets = tagged.select("source_id", "job_id", F.array_sort(F.array_distinct("tags")).alias("job_tags")).where(F.size("job_tags") > 0)
    firsts = materialize(top_per_group(sets, ["job_tags"], order, k).drop("position"), "first-postings")
    terms = sets.groupBy("job_tags").agg(F.count(F.lit(1)).alias("n")).withColumn("tag", F.explode("job_tags"))
    # A posting among the first of its tag is also among the first of its set.
    heads = top_per_group(firsts.withColumn("tag", F.explode("job_tags")), ["tag"], order, k)
    heads = heads.select("tag", "job_tags").distinct().withColumn("head", F.lit(True))
    sizes = terms.groupBy("tag").agg(F.sum("n").alias("n"))
    lists = terms.drop("n").join(heads, ["tag", "job_tags"], "left").withColumn("head", F.coalesce("head", F.lit(False)))
    return materialize(lists.join(sizes, "tag"), "tag-lists"), firsts


def _rarest_first(users: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """The users' distinct tag sets, a row for every tag that a posting has: its place from 0 with the rarest first, the
    number of such tags, and whether the rarer ones have fewer than `k` postings in all."""
    tags = lists.select("tag", "n").distinct()
    terms = users.select("user_tags").distinct().withColumn("tag", F.explode("user_tags")).join(tags, "tag")
    ordered = Window.partitionBy("user_tags").orderBy("n", "tag")
    before = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    return terms.select(
        "user_tags", "tag", (F.row_number().over(ordered) - 1).alias("place"),
        F.count(F.lit(1)).over(Window.partitionBy("user_tags")).alias("n_tags"), (F.coalesce(before, F.lit(0)) < k).alias("first"),
    )


def opened(terms: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs of a user's set and a posting's set that share one of `terms` (user_tags, tag, last), tile by tile.

    Of the last list of a user only its head is read: a posting that has none of the rarer tags overlaps in one tag,
    and so do the `k` postings of the head, which come before it.
    """
    left, right, tile = tiled(terms, lists.select("tag", "job_tags", "head"), ["tag"], "user_tags", "job_tags", TILE_ROWS)
    return left.join(right, tile).where("head OR NOT last").select("user_tags", "job_tags").distinct()


def _best(pairs: DataFrame, firsts: DataFrame, k: int) -> DataFrame:
    shared = pairs.withColumn("n_matched", F.size(F.array_intersect("user_tags", "job_tags")))
    found = shared.join(firsts, "job_tags").select("user_tags", "source_id", "job_id", "n_matched")
    return top_per_group(found, ["user_tags"], [F.desc("n_matched"), F.col("source_id"), F.col("job_id")], k)


def visits(terms: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """The lists a second round must open: a posting with at least t tags in common has one of the n - t + 1 rarest
    of a user's n tags, where t is the overlap of the `k`-th best posting so far."""
    known = best.groupBy("user_tags").agg(F.count(F.lit(1)).alias("_n"), F.min("n_matched").alias("_least"))
    least = F.when(F.col("_n") == k, F.col("_least")).otherwise(F.lit(1))
    return terms.where("NOT first").join(known, "user_tags", "left").where(F.col("place") <= F.col("n_tags") - F.coalesce(least, F.lit(1)))


def best_by_tags(users: DataFrame, tagged: DataFrame, k: int = TOP_K) -> DataFrame:
    """The `k` postings that share most tags with each user; ties by board and id. Users without tags get none.

    `users` has user_id and tags, `tagged` has source_id, job_id and tags. Users and postings meet as distinct tag
    sets. A first round opens a user's rarest tags until their lists hold `k` postings; the overlap of the `k`-th best
    of them then bounds which further lists can hold a better one, so that common tags mostly stay closed. Lists
    that are opened are cut into tiles of sets, so that a tag of a third of all postings is spread.
    """
    people = users.select("user_id", F.array_sort(F.array_distinct("tags")).alias("user_tags")).where(F.size("user_tags") > 0)
    lists, firsts = _job_sets(tagged, k)
    terms = materialize(_rarest_first(people, lists, k).withColumn("last", F.col("place") == F.col("n_tags") - 1), "user-terms")
    near = materialize(_best(opened(terms.where("first"), lists), firsts, k), "best-by-rare-tags")
    more = _best(opened(visits(terms, near, k), lists), firsts, k)
    found = near.unionByName(more).drop("position").distinct()
    found = top_per_group(found, ["user_tags"], [F.desc("n_matched"), F.col("source_id"), F.col("job_id")], k)
    return people.join(found, "user_tags").select(
        "user_id", "position", "source_id", "job_id", "n_matched",
        F.greatest(F.lit(1), F.ceil(F.lit(10) * F.col("n_matched") / F.size("user_tags"))).cast("int").alias("score"),
    )
