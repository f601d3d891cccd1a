"""Stored tables: Parquet snapshots and append-only logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at `path`, or an empty one where nothing has been written yet.

    Every other error is raised: an unreadable table must not look like an empty one, since then
    every posting would look new.
    """
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    missing = [field.name for field in schema if field.name not in stored.columns]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    return stored.select(*[stored[field.name].cast(field.dataType).alias(field.name) for field in schema])


def complete_runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the `run=` folders below `path` whose write was committed, in rising order. Folders without the
    committer's mark do not count, so a caller has to have a way on without them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [(entry.getPath(), entry.getPath().getName()) for entry in files.listStatus(folder)]
    found = [(int(name[4:]), at) for at, name in names if name.startswith("run=") and name[4:].isdigit()]
    mark = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(run for run, at in found if files.exists(mark(at, "_SUCCESS")))


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Documents of a JSON store, one per line, with a fixed schema: a missing field is null, fields
    outside the schema are dropped, and a line that is no document fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version:09d}"


def write_snapshot(df: DataFrame, root: str, version: int, partition_by: Sequence[str] = ()) -> str:
    """Write a new version next to the ones being read. Repeating a failed write replaces its files.

    Rebalancing gives each partition value few files; AQE splits a value that holds a large share of
    the rows over several tasks.
    """
    path = snapshot_path(root, version)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    # Static: a repeated write must not keep partitions of the failed one.
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
    return path


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
