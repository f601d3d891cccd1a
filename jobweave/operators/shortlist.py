"""Vector shortlist: the postings nearest to each user by cosine similarity, found through clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import top_per_group
from .tiles import tiled
from .users import subscriptions

TOP_K = 50  # fixed value: length of a user's shortlist
# Users of a tile, and a quarter of its postings. A tile passes on `k` rows a user, so large ones keep the shuffle in
# proportion to the users; both together take some ten MB.
TILE_ROWS = 8192
CLUSTER_ROWS = 4096
MAX_CLUSTERS = 1024
WHOLE_INDEX = max(2048, MAX_CLUSTERS)  # tiles that hold all clusters of a board
# Similarities that a task holds at a time.
CELLS = 1 << 21
# Far above the rounding of similarities, angles and nine digits.
TOLERANCE = 1e-6
# Similarities equal to nine digits are ties, which the job id decides.
SCALE = 1e9


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.vstack(vectors.to_numpy()).astype(np.float64)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(lengths == 0, 1, lengths)


def _posting_rows() -> int:
    return 4 * TILE_ROWS


def _near_k(likeness: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """For each row of similarities to centres the nearest clusters that hold `k` postings."""
    order = np.argsort(-likeness, axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    nearest = np.empty(likeness.shape, bool)
    np.put_along_axis(nearest, order, before < k, axis=1)
    return nearest


def _within(likeness: np.ndarray, radius: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Clusters that may hold a posting at least as similar as `least`."""
    gap = np.arccos(np.clip(likeness, -1, 1)) - radius
    return np.cos(np.maximum(gap, 0)) >= least[:, None] - TOLERANCE


class _Clusters:
    """The clusters of a tile's postings: centres, angles of the farthest postings, sizes."""

    def __init__(self, postings: np.ndarray, cluster: np.ndarray) -> None:
        _, self.of = np.unique(cluster, return_inverse=True)
        self.size = np.bincount(self.of)
        order = np.argsort(self.of, kind="stable")
        sums = np.add.reduceat(postings[order], np.cumsum(self.size) - self.size, axis=0)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        self.centre = sums / np.where(lengths == 0, 1, lengths)
        angle = np.arccos(np.clip(np.einsum("ij,ij->i", postings, self.centre[self.of]), -1, 1))
        self.radius = np.zeros(len(self.size))
        np.maximum.at(self.radius, self.of, angle)

    def order(self, users: np.ndarray) -> np.ndarray:
        """Users of a cluster behind one another, so that a block of them looks into the same ones."""
        step = max(CELLS // len(self.size), 1)
        nearest = [(users[a : a + step] @ self.centre.T).argmax(axis=1) for a in range(0, len(users), step)]
        return np.argsort(np.concatenate(nearest), kind="stable")

    def wanted(self, users: np.ndarray, postings: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
        """Places of the postings that some of the users have to be compared with. A user without `least`
        takes the `k`-th best of the nearest clusters for it."""
        likeness = users @ self.centre.T
        nearest = _near_k(likeness, self.size, k)
        if (open_ := np.isnan(least)).any():
            first = np.flatnonzero(nearest[open_].any(axis=0)[self.of])
            if 2 * len(first) > len(postings):
                return np.arange(len(postings))
            found = users[open_] @ postings[first].T
            least = least.copy()
            least[open_] = np.partition(found, len(first) - k, axis=1)[:, len(first) - k] if len(first) >= k else -2.0
        else:
            nearest[:] = False
        # A centre or similarity without a number rules nothing out.
        chosen = nearest | _within(likeness, self.radius, least) | np.isnan(likeness - self.radius)
        return np.flatnonzero(chosen.any(axis=0)[self.of])


def _tiles_compared(seekers: DataFrame, offers: DataFrame, by: list[str], k: int) -> DataFrame:
    """The `k` most similar postings per user and tile, where `by` is equal on both sides.

    Where `offers` have a cluster, a block of users is compared only with the clusters that may hold some of them. Where
    `seekers` have a `least` similarity, rows below it are left out.
    """
    left, right, tile = tiled(seekers, offers, by, "user_id", "job_id", TILE_ROWS, _posting_rows())

    def nearest(seeking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        columns = ["user_id", "source_id", "job_id", "similarity"]
        if seeking.empty or offered.empty:
            return pd.DataFrame(columns=columns)
        offered = offered.sort_values("job_id", kind="stable")
        users, postings = _unit(seeking["vector"]), _unit(offered["vector"])
        least = seeking["least"].to_numpy(np.float64, na_value=np.nan) if "least" in seeking else np.full(len(users), np.nan)
        floor = np.where(np.isnan(least), -np.inf, np.rint(least * SCALE))
        clusters = _Clusters(postings, offered["cluster"].to_numpy()) if "cluster" in offered else None
        order = clusters.order(users) if clusters else np.arange(len(users))
        step = max(CELLS // len(postings), 1)
        who, what, how = [], [], []
        for a in range(0, len(users), step):
            block = order[a : a + step]
            places = clusters.wanted(users[block], postings, least[block], k) if clusters else np.arange(len(postings))
            n = len(places)
            if not n:
                continue
            likeness = np.rint(users[block] @ (postings if n == len(postings) else postings[places]).T * SCALE)
            enough = likeness >= floor[block, None]
            if n > k and np.count_nonzero(enough) > k * len(block):
                # One integer per pair holds the similarity and, below it, the job id's place: no ties are left.
                keys = likeness.astype(np.int64) * n + np.arange(n - 1, -1, -1)
                best = np.argpartition(keys, n - k, axis=1)[:, n - k :]
                rows, picked = np.repeat(np.arange(len(block)), k), best.ravel()
                passed = ~(likeness[rows, picked] < floor[block][rows])
                rows, picked = rows[passed], picked[passed]
            else:
                rows, picked = np.nonzero(~(likeness < floor[block, None]))
            who.append(block[rows])
            what.append(places[picked])
            how.append(likeness[rows, picked].astype(np.int64) / SCALE)
        if not who:
            return pd.DataFrame(columns=columns)
        rows, picked = np.concatenate(who), np.concatenate(what)
        found = [seeking["user_id"].to_numpy()[rows], offered["source_id"].to_numpy()[picked], offered["job_id"].to_numpy()[picked], np.concatenate(how)]
        return pd.DataFrame(dict(zip(columns, found)), columns=columns)

    return left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(
        nearest, "user_id string, source_id string, job_id string, similarity double"
    )


def clustered(offers: DataFrame, cluster_rows: int) -> tuple[DataFrame, DataFrame]:
    """The index: `offers` with the cluster of each, and per cluster its centre, radius (an angle) and size.

    A board has a cluster for about `cluster_rows` postings, at most `MAX_CLUSTERS`. Its centres are the postings
    whose ids hash lowest, and a posting belongs to the nearest centre.
    """
    sizes = offers.groupBy("source_id").agg(F.least(F.ceil(F.count(F.lit(1)) / cluster_rows), F.lit(MAX_CLUSTERS)).alias("_clusters"))
    drawn = top_per_group(offers, ["source_id"], [F.xxhash64("job_id"), F.col("job_id")], MAX_CLUSTERS, "cluster")
    centres = drawn.join(sizes, "source_id").where("cluster <= _clusters").select("source_id", "cluster", F.col("vector").alias("centre"))
    centres = materialize(centres, "centres")
    left, right, tile = tiled(offers, centres, ["source_id"], "job_id", "cluster", WHOLE_INDEX)

    def place(offered: pd.DataFrame, centre: pd.DataFrame) -> pd.DataFrame:
        columns = ["source_id", "job_id", "vector", "cluster", "angle"]
        if offered.empty or centre.empty:
            return pd.DataFrame(columns=columns)
        likeness = _unit(offered["vector"]) @ _unit(centre["centre"]).T
        best = likeness.argmax(axis=1)
        angle = np.arccos(np.clip(likeness[np.arange(len(best)), best], -1, 1))
        return offered.assign(cluster=centre["cluster"].to_numpy()[best], angle=angle)[columns]

    kind = offers.schema["vector"].dataType.simpleString()
    placed = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(
        place, f"source_id string, job_id string, vector {kind}, cluster int, angle double"
    )
    placed = materialize(placed, "clustered")
    balls = placed.groupBy("source_id", "cluster").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n"))
    return placed, materialize(balls.join(centres, ["source_id", "cluster"]), "clusters")


def to_visit(seekers: DataFrame, balls: DataFrame, k: int, place: str = "cluster") -> DataFrame:
    """`seekers` (user_id, source_id, vector, least) once for every cluster, or other `place` of `balls`, that they
    must look into.

    Without `least`: for each board the nearest clusters that hold `k` postings. With `least`, the similarity of
    the best `k` found there: the other places of the board that may hold a posting as similar. A posting at an
    angle of at most r from a centre, which is at p from the user, is at p - r or more from the user.
    """
    left, right, tile = tiled(seekers, balls, ["source_id"], "user_id", "cluster", WHOLE_INDEX)

    def choose(seeking: pd.DataFrame, ball: pd.DataFrame) -> pd.DataFrame:
        columns = ["user_id", "source_id", "vector", "least", place]
        if seeking.empty or ball.empty:
            return pd.DataFrame(columns=columns)
        ball = ball.sort_values([place, "cluster"])
        names, starts = np.unique(ball[place].to_numpy(), return_index=True)
        likeness = _unit(seeking["vector"]) @ _unit(ball["centre"]).T
        least = seeking["least"].to_numpy(np.float64, na_value=np.nan)
        nearest = np.logical_or.reduceat(_near_k(likeness, ball["n"].to_numpy(), k), starts, axis=1)
        within = np.logical_or.reduceat(_within(likeness, ball["radius"].to_numpy(), least), starts, axis=1)
        user, at = np.nonzero(np.where(np.isnan(least)[:, None], nearest, within & ~nearest))
        return seeking.iloc[user].assign(**{place: names[at]})[columns]

    kind = seekers.schema["vector"].dataType.simpleString()
    return left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(
        choose, f"user_id string, source_id string, vector {kind}, least double, {place} {balls.schema[place].dataType.simpleString()}"
    )


def shelved(placed: DataFrame, balls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index with its clusters put together on shelves that hold a tile of postings, so that a user is sent
    once for many clusters."""
    before = Window.partitionBy("source_id").orderBy("cluster").rowsBetween(Window.unboundedPreceding, -1)
    shelf = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / _posting_rows()).cast("int")
    # At most `MAX_CLUSTERS` rows a board.
    balls = materialize(balls.withColumn("shelf", shelf), "shelves")
    return placed.join(balls.select("source_id", "cluster", "shelf"), ["source_id", "cluster"]), balls


def _first(rows: DataFrame, k: int) -> DataFrame:
    """The `k` best rows of every user; tasks pass on `k` rows a user, and a user's rows are some tiles' of `k`."""
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("similarity"), "source_id", "job_id"))
    return rows.withColumn("position", rank).filter(F.col("position") <= k)


def shortlist(users: DataFrame, postings: DataFrame, k: int = TOP_K, cluster_rows: int | None = None) -> DataFrame:
    """The `k` most similar postings per user, within the user's subscribed sources.

    `users` has user_id, enabled_sources and vector; `postings` has source_id, job_id and vector.
    The result is exact. Postings are clustered per board; a user first looks into the shelves of the nearest clusters,
    and then only into those with a cluster that the bound of its centre and radius against the `k`-th best does not
    rule out. Users and postings of a shelf are cut into tiles of bounded size; one task compares a tile of users with a
    tile of postings, cluster by cluster under the same bound, by matrix products and keeps `k` rows per user, so a source
    with a third of all postings becomes many equal tasks, and what leaves a task is at most `k` rows per user rather than
    its pairs. Where no board has postings for a second cluster, there is nothing to rule out and the boards are compared
    as they are.
    """
    cluster_rows = cluster_rows or CLUSTER_ROWS
    seekers = subscriptions(users, "enabled_sources", "vector")
    offers = postings.select("source_id", "job_id", "vector")
    largest = offers.groupBy("source_id").count().agg(F.max("count")).first()[0] or 0
    if largest <= cluster_rows:
        return _first(_tiles_compared(seekers, offers, ["source_id"], k), k)
    placed, balls = shelved(*clustered(offers, cluster_rows))
    placed = placed.drop("angle")
    by = ["source_id", "shelf"]
    near = _tiles_compared(to_visit(seekers.withColumn("least", F.lit(None).cast("double")), balls, k, "shelf"), placed, by, k)
    if not balls.agg(F.max("shelf")).first()[0]:
        return _first(near, k)
    best = materialize(_first(near, k), "nearest")
    found = best.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"), F.min("similarity").alias("_least"))
    least = F.when(F.col("_n") == k, F.col("_least")).otherwise(F.lit(-2.0))
    rest = seekers.join(found, "user_id", "left").select(*seekers.columns, least.alias("least"))
    others = materialize(to_visit(rest, balls, k, "shelf"), "shelves-left")
    more = best.drop("position").unionByName(_tiles_compared(others, placed, by, k))
    return _first(more, k)
