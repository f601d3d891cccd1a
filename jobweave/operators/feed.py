"""The ranked, paged feed of every user in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import top_per_group
from .store import EVALUATION_KEY, POSTING_KEY
from .users import effective_sources, subscriptions

PAGE_LIMIT = 20  # fixed value: page size unless given


def keeps(score: Column, min_score: int) -> Column:
    """With a minimum of 0 everything stays (scores are never negative); above it unscored postings go."""
    return F.lit(True) if min_score == 0 else F.coalesce(score >= min_score, F.lit(False))


def _requests(users: DataFrame, source: Column | None) -> DataFrame:
    wanted = F.lit(None).cast("string") if source is None else source
    return users.withColumn("_sources", effective_sources(wanted, F.col("enabled_sources")))


def source_choice(users: DataFrame, source: Column) -> DataFrame:
    """Sources a request with the given source filter reads, one row per user and source."""
    return subscriptions(_requests(users, source), "_sources")


def feed(
    users: DataFrame,
    postings: DataFrame,
    evaluations: DataFrame,
    page: int = 1,
    limit: int = PAGE_LIMIT,
    min_score: int = 0,
    source: Column | None = None,
) -> DataFrame:
    """One page per user: scored postings by score, then unscored ones; ties by source and job id.

    No plan step lists users x postings. The scored part comes from the evaluations. Where it does not
    fill the page, the rest comes from the heads of the subscribed sources (see `_unscored`). Totals
    come from counts per source. Texts of postings are joined to the page's rows only.
    """
    if page < 1 or limit < 1 or not 0 <= min_score <= 10:
        raise ValueError("page >= 1, limit >= 1 and 0 <= min_score <= 10 are required")
    last = page * limit
    wanted = subscriptions(_requests(users, source), "_sources")
    # Read up to three times below.
    scored = materialize(_scored(wanted, postings, evaluations, min_score, "summary"), "scored")
    columns = ["user_id", *POSTING_KEY, "score", "summary", "position", "total"]
    best_first = [F.desc("score"), *[F.col(c) for c in POSTING_KEY]]
    rows = top_per_group(scored, ["user_id"], best_first, last).filter(F.col("position") > last - limit)
    if min_score > 0:
        totals = scored.groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))
        return _described(rows.join(totals, "user_id").select(*columns), postings, limit)
    # Written, so that the few heads are known to be few before anything is joined with them.
    heads = materialize(top_per_group(postings.select(*POSTING_KEY), ["source_id"], [F.col("job_id")], last, "head"), "heads")
    shares = _shares(wanted, postings, scored, heads)
    totals = shares.groupBy("user_id").agg(F.sum("n_postings").alias("total"))
    rest = _unscored(shares, evaluations, heads, last, limit).select(*columns)
    named = materialize(postings.join(heads.select(*POSTING_KEY).distinct(), [*POSTING_KEY], "left_semi"), "head-postings")
    done = _described(rows.join(totals, "user_id").select(*columns), postings, limit)
    return done.unionByName(_described(rest, named, limit))


def _described(rows: DataFrame, postings: DataFrame, limit: int) -> DataFrame:
    return rows.join(postings, [*POSTING_KEY]).select(
        "user_id",
        "position",
        "job_id",
        "source_id",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "location", "contract_type", "deadline", "url")],
        "score",
        "summary",
        "scraped_at",
        "total",
        _pages(F.col("total"), limit).alias("n_pages"),
    )


def feed_totals(
    users: DataFrame,
    postings: DataFrame,
    evaluations: DataFrame,
    limit: int = PAGE_LIMIT,
    min_score: int = 0,
    source: Column | None = None,
) -> DataFrame:
    """Rows and pages of every user's feed, also of an empty one: what a page without rows must still tell."""
    wanted = subscriptions(_requests(users, source), "_sources")
    if min_score == 0:
        per_source = postings.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
        counts = wanted.join(per_source, "source_id").groupBy("user_id").agg(F.sum("n").alias("total"))
    else:
        counts = _scored(wanted, postings, evaluations, min_score).groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))
    total = F.coalesce("total", F.lit(0))
    return users.select("user_id").join(counts, "user_id", "left").select(
        "user_id", total.alias("total"), _pages(total, limit).alias("n_pages")
    )


def _pages(total: Column, limit: int) -> Column:
    return F.greatest(F.ceil(total / limit), F.lit(1))


def _scored(wanted: DataFrame, postings: DataFrame, evaluations: DataFrame, min_score: int, *columns: str) -> DataFrame:
    """Scored evaluations of postings in the sources that the user reads."""
    return (
        evaluations.filter(F.col("score").isNotNull() & keeps(F.col("score"), min_score))
        .select(*EVALUATION_KEY, "score", *columns)
        .join(postings.select(*POSTING_KEY), list(POSTING_KEY), "left_semi")
        .join(wanted, ["user_id", "source_id"], "left_semi")
    )


def _shares(wanted: DataFrame, postings: DataFrame, scored: DataFrame, heads: DataFrame) -> DataFrame:
    """Postings of each subscribed source, how many of them the user has scored, and which of its head."""
    per_source = postings.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_postings"))
    at_head = heads.select(*POSTING_KEY).distinct().withColumn("_at_head", F.lit(True))
    own = F.collect_set(F.when(F.col("_at_head"), F.col("job_id"))).alias("own")
    done = scored.select("user_id", *POSTING_KEY).join(at_head, list(POSTING_KEY), "left")
    done = done.groupBy("user_id", "source_id").agg(F.count(F.lit(1)).alias("n_scored"), own)
    return (
        wanted.join(per_source, "source_id")
        .join(done, ["user_id", "source_id"], "left")
        .withColumn("n_scored", F.coalesce("n_scored", F.lit(0)))
    )


def _unscored(shares: DataFrame, evaluations: DataFrame, heads: DataFrame, last: int, limit: int) -> DataFrame:
    """Unscored rows up to position `last` for the users whose scored rows end before it, the last `limit` of them.

    A user short of m rows takes them from the subscribed sources in turn. From a source with s scored
    postings, its first m + s ids hold m unscored ones, or all there are; m + s never exceeds `last`.
    So the heads of the sources are enough, and a user meets no more than about `last` of their rows.
    These stay an array in the user's row until the page is known, so no step moves them one by one.
    The windows here run over one user's subscriptions, which are an array in the user's row.
    """
    per_user = Window.partitionBy("user_id")
    earlier = per_user.orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1)
    unscored = F.col("n_postings") - F.col("n_scored")
    remarks = evaluations.filter(F.col("score").isNull()).join(heads.select(*POSTING_KEY), list(POSTING_KEY), "left_semi")
    remarks = remarks.groupBy("user_id", "source_id").agg(F.collect_list(F.struct("job_id", "summary")).alias("remarks"))
    short = (
        shares.join(remarks, ["user_id", "source_id"], "left")
        .withColumns({"n_all": F.sum("n_scored").over(per_user), "total": F.sum("n_postings").over(per_user)})
        .withColumn("missing", F.lit(last) - F.col("n_all") - F.coalesce(F.sum(unscored).over(earlier), F.lit(0)))
        .filter("missing > 0 AND user_id IS NOT NULL")
        .withColumn("take", (F.col("missing") + F.col("n_scored")).cast("int"))
    )
    lists = heads.groupBy("source_id").agg(F.sort_array(F.collect_list(F.struct("head", "job_id"))).alias("jobs"))

    def row(job: Column) -> Column:
        said = F.filter(F.col("remarks"), lambda r: r["job_id"] == job)
        return F.struct(F.col("source_id"), job.alias("job_id"), F.transform(said, lambda r: r["summary"]).alias("said"))

    first = F.slice(F.transform("jobs", lambda j: j["job_id"]), 1, F.col("take"))
    left = F.filter(first, lambda j: ~F.coalesce(F.array_contains("own", j), F.lit(False)))
    mine = short.join(lists, "source_id").select("user_id", "n_all", "total", F.transform(left, row).alias("rows"))
    numbers = [F.max("n_all").cast("int").alias("n_all"), F.max("total").alias("total")]
    mine = mine.groupBy("user_id").agg(*numbers, F.sort_array(F.flatten(F.collect_list("rows"))).alias("rows"))
    before = F.greatest(F.lit(last - limit) - F.col("n_all"), F.lit(0))
    page = F.slice("rows", before + 1, F.lit(last) - F.col("n_all") - before)
    placed = mine.select("user_id", "total", (F.col("n_all") + before).alias("_before"), F.posexplode(page).alias("_at", "row"))
    return placed.select(
        "user_id",
        "row.source_id",
        "row.job_id",
        F.lit(None).cast("int").alias("score"),
        F.explode_outer("row.said").alias("summary"),
        (F.col("_before") + F.col("_at") + 1).cast("int").alias("position"),
        "total",
    )
