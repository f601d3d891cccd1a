"""Backfill of incomplete postings and migration of the single-user store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import composite_key, is_blank, iso_timestamp, strip
from ..schemas import POSTING_TEXT
from .ranking import first_per_group

# Fields taken from a listing, and the text that marks an expired posting's title.
LISTED_FIELDS = ("title", "location", "contract_type", "deadline")
CLOSED_MARK = "Closed Job"


def untitled_postings(postings: DataFrame, source_id: Column) -> DataFrame:
    return postings.filter((F.col("source_id") == source_id) & (F.coalesce("title", F.lit("")) == ""))


def match_listing(untitled: DataFrame, stubs: DataFrame, order: list[Column]) -> DataFrame:
    """Each incomplete posting with the last stub of its id and `matched`."""
    fields = [F.col(c).alias(f"new_{c}") for c in LISTED_FIELDS]
    found = first_per_group(stubs, ["source_id", "job_id"], order).select(
        "source_id", "job_id", *fields, F.lit(True).alias("_found")
    )
    return untitled.join(found, ["source_id", "job_id"], "left").withColumn(
        "matched", F.coalesce("_found", F.lit(False))
    ).drop("_found")


def pages_of(postings: DataFrame, pages: DataFrame) -> DataFrame:
    """The pages of these postings, to be parsed; all others are left out before."""
    return pages.join(postings.select("url").filter("url <> ''").distinct(), "url", "left_semi")


def with_details(matched: DataFrame, details: DataFrame) -> DataFrame:
    """Complete matches from detail pages (`url` and the fields found there).

    A posting missing in the listing takes all fields from its page; one in the listing only the
    description, which listings do not have.
    """
    fields = [*LISTED_FIELDS, "description_raw"]
    pages = first_per_group(details.filter("url <> ''"), ["url"], [F.col(f) for f in fields]).select(
        "url", *[F.col(f).alias(f"_page_{f}") for f in fields]
    )
    listed = {f"new_{f}": F.when(F.col("matched"), F.col(f"new_{f}")).otherwise(F.col(f"_page_{f}")) for f in LISTED_FIELDS}
    return (
        matched.join(pages, "url", "left")
        .withColumns({**listed, "new_description_raw": F.col("_page_description_raw")})
        .drop(*[f"_page_{f}" for f in fields])
    )


def patch(matched: DataFrame, tracking_prefix: str) -> DataFrame:
    """Add `patched_<field>` and `changed`: recovered values fill blank fields only, and a title that
    looks like that of an expired posting is refused."""
    columns = {}
    for field in (*LISTED_FIELDS, "description_raw"):
        if f"new_{field}" not in matched.columns:
            continue
        new = F.coalesce(F.col(f"new_{field}"), F.lit(""))
        # A listing's value is trimmed; a recovered description is taken as it is.
        new = strip(new) if field in LISTED_FIELDS else new
        usable = new != ""
        if field == "title":
            usable = usable & ~new.contains(CLOSED_MARK) & ~new.startswith(tracking_prefix)
        columns[field] = F.when(is_blank(field) & usable, new).otherwise(F.col(field))
    patched = matched.withColumns({f"patched_{field}": value for field, value in columns.items()})
    differs = [~F.col(f"patched_{field}").eqNullSafe(F.col(field)) for field in columns]
    changed = differs[0]
    for other in differs[1:]:
        changed = changed | other
    return patched.withColumn("changed", changed)


def field_changes(patched: DataFrame) -> DataFrame:
    """One row per changed field with its old and new value."""
    pairs = [
        F.struct(F.lit(f).alias("field"), F.col(f).alias("old"), F.col(f"patched_{f}").alias("new"))
        for f in LISTED_FIELDS
    ]
    return (
        patched.select("source_id", "job_id", F.inline(F.array(*pairs)))
        .filter(~F.col("old").eqNullSafe(F.col("new")))
    )


def patch_tally(patched: DataFrame) -> DataFrame:
    return patched.agg(
        F.count(F.lit(1)).alias("n_empty"),
        F.count_if("matched").alias("n_matched"),
        F.count_if("changed").alias("n_patched"),
    )


def apply_patch(postings: DataFrame, patched: DataFrame) -> DataFrame:
    """New snapshot with the changed postings in place of the stored ones."""
    fields = [f for f in (*LISTED_FIELDS, "description_raw") if f"patched_{f}" in patched.columns]
    changes = patched.filter("changed").select(
        "source_id", "job_id", *[F.col(f"patched_{f}") for f in fields], F.lit(True).alias("_changed")
    )
    joined = postings.join(changes, ["source_id", "job_id"], "left")
    updates = {f: F.when(F.col("_changed"), F.col(f"patched_{f}")).otherwise(F.col(f)) for f in fields}
    return joined.withColumns(updates).select(*postings.columns)


def migrate_postings(legacy: DataFrame, source_id: str, run_at: Column) -> DataFrame:
    """Postings of the single-user store with their board, no nulls and text timestamps."""
    return legacy.select(
        composite_key(F.lit(source_id), "job_id").alias("id"),
        "job_id",
        F.lit(source_id).alias("source_id"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in POSTING_TEXT],
        iso_timestamp("scraped_at", run_at).alias("scraped_at"),
    )


def migrate_evaluations(legacy: DataFrame, user_id: str, source_id: str, run_at: Column) -> DataFrame:
    """Evaluations of the single-user store for one account; failed ones (score 0) stay behind.

    A row without score has no integer to carry over and stays behind as well.
    """
    return legacy.filter("score <> 0").select(
        composite_key(F.lit(user_id), "job_id").alias("id"),
        F.lit(user_id).alias("user_id"),
        "job_id",
        F.lit(source_id).alias("source_id"),
        "score",
        F.coalesce("summary", F.lit("")).alias("summary"),
        F.coalesce("email_sent", F.lit(False)).alias("email_sent"),
        iso_timestamp("evaluated_at", run_at).alias("evaluated_at"),
    )
