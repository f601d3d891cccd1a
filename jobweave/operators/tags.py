"""Tags of postings and users, and scores from their overlap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .scoring import Scorer, column_scorer
from .tiles import tiled

TILE_ROWS = 512

# The tag taxonomy by domain.
TAXONOMY: Mapping[str, Sequence[str]] = {
    "Data & Analytics": ("data-engineer", "data-analyst", "data-scientist", "bi-developer", "data-governance"),
    "Finance": ("accountant", "financial-analyst", "budget-officer", "auditor", "treasury"),
    "IT & Engineering": ("software-engineer", "devops", "cybersecurity", "it-support", "project-manager-tech"),
    "Development": ("economist", "project-manager", "procurement", "communications", "hr"),
    "Leadership": ("director", "vp", "chief-officer", "team-lead"),
}


def taxonomy_table(spark: SparkSession, taxonomy: Mapping[str, Sequence[str]] = TAXONOMY) -> DataFrame:
    """tag and keyword, which is the tag with blanks for hyphens."""
    rows = [(tag, tag.replace("-", " ")) for tags in taxonomy.values() for tag in tags]
    return spark.createDataFrame(rows, "tag string, keyword string")


def text_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _word_runs(words: Column, n: int) -> Column:
    """All runs of `n` words, joined by blanks."""
    places = F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1)))
    return F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " "))


def tag_new_postings(postings: DataFrame, tagged: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Key and sorted tags of the postings that are not tagged yet, with those that have none.

    `taxonomy` has tag and keyword. A keyword occurs in a text if its words stand there in a row, without
    regard to case. Word sequences of the texts, as long as keywords are, are joined with the keywords, so
    the taxonomy may be of any size.
    """
    key = ["source_id", "job_id"]
    todo = postings.join(tagged.select(*key), key, "left_anti")
    wanted = taxonomy.select("tag", text_words(F.col("keyword")).alias("_words")).filter(F.size("_words") > 0)
    lengths = [r[0] for r in wanted.select(F.size("_words")).distinct().collect()]
    words = todo.select(*key, text_words(F.concat_ws(" ", "title", "description_raw")).alias("_text"))
    runs = [_word_runs(F.col("_text"), n) for n in lengths]
    none = todo.select(*key).distinct()
    if not runs:
        return none.withColumn("tags", F.array().cast("array<string>"))
    seen = words.select(*key, F.explode(F.array_distinct(F.concat(*runs))).alias("_run"))
    found = seen.join(wanted.select("tag", F.array_join("_words", " ").alias("_run")), "_run")
    per_posting = found.groupBy(*key).agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    return none.join(per_posting, key, "left").withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))


def overlap(job_tags: Column, user_tags: Column) -> dict[str, Column]:
    """Matched and wanted tag counts, and a score 1–10 from their ratio (null without user tags)."""
    n_user = F.size(F.array_distinct(user_tags))
    n_match = F.size(F.array_intersect(job_tags, user_tags))
    score = F.greatest(F.lit(1), F.ceil(F.lit(10) * n_match / n_user)).cast("int")
    return {
        "n_matched": n_match,
        "n_wanted": n_user,
        "score": F.when(n_user > 0, score),
    }


def tag_scorer() -> Scorer:
    """Deterministic scorer for pairs that carry `job_tags` and `user_tags`."""
    parts = overlap(F.col("job_tags"), F.col("user_tags"))
    summary = F.concat(
        parts["n_matched"].cast("string"), F.lit("/"), parts["n_wanted"].cast("string"), F.lit(" tags matched")
    )
    return column_scorer(F.to_json(F.struct(parts["score"].alias("score"), summary.alias("summary"))))


def with_fallback(pairs: DataFrame, fallback: Scorer) -> DataFrame:
    """Tag scorer for users with tags, `fallback` for the others. A `column_scorer` answers in the same pass; for
    any other scorer the pairs are written once for both."""
    has_tags = F.size(F.coalesce("user_tags", F.array().cast("array<string>"))) > 0
    if (answer := getattr(fallback, "answer", None)) is not None:
        return pairs.withColumn("response", F.when(has_tags, tag_scorer().answer).otherwise(answer))
    pairs = materialize(pairs, "pairs")
    return tag_scorer()(pairs.filter(has_tags)).unionByName(fallback(pairs.filter(~has_tags)))


def match_counts(users: DataFrame, tagged: DataFrame) -> DataFrame:
    """Per user and score above the minimum: how many postings reach it by tag overlap.

    Equal tag sets have equal scores. Users and postings are first reduced to their distinct tag sets
    with counts, and only sets that share a tag meet, tile by tile, so that a tag of many sets is spread;
    no (user, posting) pair is listed.
    """
    user_sets = users.select("user_id", F.array_sort(F.array_distinct("tags")).alias("user_tags")).filter(
        F.size("user_tags") > 0
    )
    job_sets = (
        tagged.select(F.array_sort(F.array_distinct("tags")).alias("job_tags"))
        .groupBy("job_tags")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    user_terms = user_sets.select("user_tags").distinct().withColumn("tag", F.explode("user_tags"))
    job_terms = job_sets.withColumn("tag", F.explode("job_tags"))
    left, right, tile = tiled(user_terms, job_terms, ["tag"], "user_tags", "job_tags", TILE_ROWS)
    shared = (
        left.join(right, tile)
        .groupBy("user_tags", "job_tags")
        .agg(F.count(F.lit(1)).alias("n_matched"), F.max("n").alias("n"))
    )
    score = F.greatest(F.lit(1), F.ceil(F.lit(10) * F.col("n_matched") / F.size("user_tags"))).cast("int")
    per_set = (
        shared.withColumn("score", score)
        .groupBy("user_tags", "n_matched", "score")
        .agg(F.sum("n").alias("n_postings"))
    )
    label = F.concat(F.col("n_matched").cast("string"), F.lit("/"), F.size("user_tags").cast("string"), F.lit(" tags matched"))
    return user_sets.join(per_set, "user_tags").select(
        "user_id", "score", label.alias("label"), "n_postings"
    )


def tag_distribution(tagged: DataFrame) -> DataFrame:
    return tagged.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n_postings"))


def with_tag(tagged: DataFrame, tag: str) -> DataFrame:
    return tagged.filter(F.array_contains("tags", tag))


def keyword_hits(postings: DataFrame, sources: DataFrame) -> DataFrame:
    """Postings that contain a search keyword of their board, with the matching keywords sorted.

    Keywords travel as one array per board, so a posting meets its board's keywords without a row per
    pair.
    """
    lists = sources.select("source_id", F.col("search_keywords").alias("_words"))
    text = F.lower(F.concat_ws(" ", "title", "description_raw"))
    hits = F.array_sort(F.array_distinct(F.filter("_words", lambda word: F.col("_text").contains(F.lower(word)))))
    return (
        postings.join(lists, "source_id")
        .withColumn("_text", text)
        .withColumn("keywords", hits)
        .filter(F.size("keywords") > 0)
        .select("source_id", "job_id", "keywords")
    )
