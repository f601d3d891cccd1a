"""First row, top k and running position per group, without putting a hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SPREAD = 64


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, position: str = "position"
) -> DataFrame:
    """The first `k` rows of each group, numbered from 1.

    A first round works on parts of every group, so that the final round sees at most SPREAD * k rows of
    it, however many tasks held some.
    """
    spread = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)))
    local = Window.partitionBy(*group, "_part").orderBy(*order)
    kept = spread.withColumn("_local", F.row_number().over(local)).filter(F.col("_local") <= k).drop("_part", "_local")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return kept.withColumn(position, rank).filter(F.col(position) <= k)


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per group: the first in `order`. Each task passes on one row of a group."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_position", rank).filter("_position = 1").drop("_position")


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], position: str = "position"
) -> DataFrame:
    """Number all rows of every group from 1 in `order`, which must be total.

    Rows are range-partitioned by group and order, so a hot group spans many partitions in sequence.
    Each partition numbers its own rows; a group that began in an earlier partition adds the rows it
    has there. Only the first group of a partition can have begun earlier, so the table of additions
    has at most one row per partition. The range-partitioned rows are written once because both halves
    must see the same boundaries, also when a lost task is run again.
    """
    keys = [F.col(g) for g in group]
    spread = df.repartitionByRange(*keys, *order).withColumn("_chunk", F.spark_partition_id())
    stored = materialize(spread, "numbered")
    sizes = stored.groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    additions = sizes.select(*group, "_chunk", F.sum("_n").over(earlier).alias("_before")).filter("_before > 0")
    local = Window.partitionBy(*group, "_chunk").orderBy(*order)
    number = F.coalesce("_before", F.lit(0)) + F.col("_local")
    return (
        stored.withColumn("_local", F.row_number().over(local))
        .join(additions, [*group, "_chunk"], "left")
        .withColumn(position, number.cast("int"))
        .select(*df.columns, position)
    )
