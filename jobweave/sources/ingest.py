"""Raw records of many boards to canonical postings."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import composite_key
from ..schemas import POSTING_TEXT, POSTINGS
from ..session import materialize

Loader = Callable[[SparkSession, Mapping[str, object]], DataFrame]


def _text(raw: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in raw.columns else F.lit("")


def normalize(raw: DataFrame, source_id: Column, run_at: Column) -> DataFrame:
    """Canonical posting columns: missing text becomes '', a blank collection time the run's time."""
    seen_at = F.coalesce(F.nullif(_text(raw, "scraped_at"), F.lit("")), run_at.cast("string"))
    return raw.select(
        _text(raw, "job_id").alias("job_id"),
        source_id.alias("source_id"),
        *[_text(raw, name).alias(name) for name in POSTING_TEXT],
        seen_at.alias("scraped_at"),
    )


def with_composite_key(postings: DataFrame) -> DataFrame:
    return postings.withColumn("id", composite_key("source_id", "job_id"))


def merge_extras(postings: DataFrame, extra: str = "extra", extra_wins: bool = True) -> DataFrame:
    """All fields of a record as one map: canonical fields plus the board's own.

    The board's value wins on a clash; with `extra_wins=False` the canonical field does.
    """
    names = [field.name for field in POSTINGS]
    pairs = [part for name in names for part in (F.lit(name), F.col(name).cast("string"))]
    base = F.create_map(F.lit("id"), composite_key("source_id", "job_id"), *pairs)
    own = F.coalesce(F.col(extra), F.create_map().cast("map<string,string>"))
    winner, loser = (own, base) if extra_wins else (base, own)
    rest = F.map_filter(loser, lambda key, _: ~F.map_contains_key(winner, key))
    return postings.withColumn("record", F.map_concat(rest, winner)).drop(extra)


def ingest_sources(
    spark: SparkSession,
    configs: Mapping[str, Mapping[str, object]],
    loaders: Mapping[str, Loader],
    run_at: Column,
) -> tuple[DataFrame, DataFrame]:
    """Union of the normalised records of all enabled boards, and one status row per board.

    A board without loader, or whose loader is a placeholder (NotImplementedError), is skipped. Each board
    is read and written apart: whatever fails in one, also while its rows are read, is reported in its
    status row, and the others go on.
    """
    frames, status = [], []
    for source_id, config in configs.items():
        if not config.get("enabled", False):
            status.append((source_id, "disabled", None))
            continue
        try:
            if source_id not in loaders:
                raise NotImplementedError
            raw = loaders[source_id](spark, config)
            frames.append(materialize(normalize(raw, F.lit(source_id), run_at), "board"))
        except NotImplementedError:
            status.append((source_id, "placeholder", None))
            continue
        except Exception as error:  # noqa: BLE001 - a board may fail in any way
            status.append((source_id, "failed", (str(error).splitlines() or [type(error).__name__])[0]))
            continue
        status.append((source_id, "loaded", None))
    empty = spark.createDataFrame([], POSTINGS)
    records = reduce(DataFrame.unionByName, frames, empty)
    return records, spark.createDataFrame(status, "source_id string, status string, error string")


def new_by_source(new_postings: DataFrame) -> DataFrame:
    """New postings per board, with a row `(all)` for the total."""
    return (
        new_postings.rollup("source_id")
        .agg(F.grouping_id().alias("_level"), F.count(F.lit(1)).alias("n_new"))
        .select(F.when(F.col("_level") == 1, "(all)").otherwise(F.col("source_id")).alias("source_id"), "n_new")
    )


def source_health(registry: DataFrame, records: DataFrame) -> DataFrame:
    """Rows delivered per enabled board; `is_silent` marks boards that delivered none."""
    counts = records.groupBy("source_id").agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    return (
        registry.filter("enabled")
        .select("source_id")
        .join(counts, "source_id", "left")
        .select("source_id", n.alias("n_records"), (n == 0).alias("is_silent"))
    )
