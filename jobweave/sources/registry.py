"""The registry of job boards. It is configuration: a few rows, written by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import short_display_name, source_label
from ..schemas import SOURCES

DEFAULT_COLOR = "#555555"  # fixed value


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return with_defaults(spark.read.schema(SOURCES).json(path, multiLine=True))


def read_registry_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Registry from a YAML file with a mapping `sources` from board id to its settings."""
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML needs the yaml package; convert the file to JSON instead") from error
    text = spark.read.text(path, wholetext=True).first()
    boards = (yaml.safe_load(text[0] if text else "") or {}).get("sources") or {}
    names = [field.name for field in SOURCES if field.name != "source_id"]
    rows = [(source_id, *[settings.get(name) for name in names]) for source_id, settings in boards.items()]
    return with_defaults(spark.createDataFrame(rows, SOURCES))


def with_defaults(sources: DataFrame) -> DataFrame:
    return sources.withColumns(
        {
            "display_name": F.coalesce("display_name", "source_id"),
            "enabled": F.coalesce("enabled", F.lit(False)),
            "enabled_by_default": F.coalesce("enabled_by_default", F.lit(False)),
            "color": F.coalesce("color", F.lit(DEFAULT_COLOR)),
        }
    )


def board_configs(sources: DataFrame) -> dict[str, dict]:
    """Settings per board id, for `ingest.ingest_sources`, which runs a loader for each board."""
    return {row.source_id: row.asDict() for row in with_defaults(sources).toLocalIterator()}


def open_sources(sources: DataFrame) -> DataFrame:
    """Boards a user may subscribe to; `preselected` marks those ticked for new accounts."""
    chosen = with_defaults(sources).filter("enabled")
    return chosen.select(
        "source_id", "display_name", "color", F.col("enabled_by_default").alias("preselected")
    )


def source_labels(sources: DataFrame) -> DataFrame:
    filled = with_defaults(sources)
    return filled.select(
        "source_id",
        source_label("label", "source_id").alias("label"),
        short_display_name("display_name").alias("short_name"),
        "color",
    )


def unknown_sources(requests: DataFrame, sources: DataFrame, key: str, requested: str = "requested") -> DataFrame:
    """Requests that name boards outside the registry, with the sorted offenders.

    Each requested name is looked up by an equi-join, so the registry is never collected.
    """
    names = requests.select(key, F.explode(F.array_distinct(requested)).alias("source_id"))
    return (
        names.join(sources.select("source_id"), "source_id", "left_anti")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("source_id")).alias("unknown"))
    )
