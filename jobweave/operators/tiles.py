"""Many-to-many work in tiles of bounded size.

Where two tables meet on a key that many rows of both share, a task per key would be as large as the
product of both groups. Here the groups are cut into tiles by a hash, and each row is sent once to every
tile of the other side; a hot key becomes many tiles of the same size as all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tiled(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_key: str, right_key: str, tile_rows: int, right_rows: int | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both tables with the columns `left_tile` and `right_tile`, and the columns that name a tile.

    A tile has about `tile_rows` rows of each side, or `right_rows` of the right one. Keys of one side only are dropped.
    """

    def tiles(df: DataFrame, name: str, rows: int) -> DataFrame:
        return df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))

    counts = tiles(left, "_left", tile_rows).join(tiles(right, "_right", right_rows or tile_rows), list(by))

    def spread(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        placed = df.join(counts, list(by)).withColumn(f"{own}_tile", F.pmod(F.xxhash64(key), F.col(f"_{own}")).cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col(f"_{other}") - 1))
        return placed.withColumn(f"{other}_tile", every).drop("_left", "_right")

    keys = [*by, "left_tile", "right_tile"]
    return spread(left, left_key, "left", "right"), spread(right, right_key, "right", "left"), keys
