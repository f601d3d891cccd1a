"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation.

A vector is a sparse row: its terms are the places of its non-zero components, and floor(256 * x) is a term's
weight. Queries and candidates are cut into tiles by a hash of the row, and a task gets one tile of each. It turns
blocks of its candidates into postings (term -> rows and weights), takes the terms one after another and scatters
weight times query weight into a dense array of scores, a row per candidate and a column per query. After the last
term the array is final: a partition selection keeps `k` rows a query, which are merged block by block in the task
and then over all tiles.

Scale: a tile has at most about `QUERY_ROWS` queries and `CANDIDATE_ROWS` candidates, so a row is sent once to
every tile of the other side, and the score array has `BLOCK_ROWS` * `BLOCK_QUERIES` entries whatever the input.
The work is that of the queries times all rows, in tasks of equal size; what leaves a task is `k` rows a query.

Defined results: vectors that are null, or hold a null or non-finite component, take no part; components beyond the
end of the shorter vector count as zero, so an empty vector scores 0. Rows are told apart by a number of their own:
of rows with one id each is a query, and the others are its candidates. Equal scores go by smaller id, null ids
last, and a null id is no query. Arithmetic is exact; scores beyond 64 bits count as the nearest long. Fewer than `k` candidates give fewer rows, an empty table none. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_per_group
from .common import written

K = 5
SCALE = 256
QUERY_ROWS = 16_384
CANDIDATE_ROWS = 131_072
LEAST_CANDIDATES = 2_048
TILES = 256
BLOCK_ROWS = 2_048
BLOCK_QUERIES = 64
LONG = 2**63 - 1


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def weights(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, term and weight of every non-zero weight; object integers where 64 bits might not hold a sum."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    values = np.floor(np.asarray(vectors.flatten(), np.float64) * SCALE)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    there = values != 0
    values = values[there]
    if len(values) and np.abs(values).max() >= 2.0**53:
        return row[there], term[there], np.array([int(v) for v in values], object)
    return row[there], term[there], values.astype(np.int64)


def number_type(left: Postings, right: Postings):
    """The narrowest type that holds every score of two sides and, for 64 bits, a place among the rows below it."""
    top = lambda w: max(1, int(abs(w).max())) if len(w) else 1
    bound = top(left.weight) * top(right.weight) * max(1, min(len(left.terms), len(right.terms)))
    return np.int32 if bound < 2**31 else np.int64 if bound * max(left.rows, 1) < 2**62 else object


class Postings:
    """Postings of a block of candidates: for every term the rows that have it and their weights."""

    def __init__(self, rows: int, row: np.ndarray, term: np.ndarray, weight: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.rows, self.row, self.weight = rows, row[order], weight[order]
        self.terms, starts = np.unique(term[order], return_index=True)
        self.bounds = np.append(starts, len(order))

    def scores(self, queries: Postings) -> np.ndarray:
        """The dense array of scores, a row per candidate and a column per query, one term after another."""
        kind = number_type(self, queries)
        out = np.zeros((self.rows, queries.rows), kind)
        mine, theirs = self.weight.astype(kind), queries.weight.astype(kind)
        _, left, right = np.intersect1d(self.terms, queries.terms, assume_unique=True, return_indices=True)
        for i, j in zip(left, right):
            a, b = slice(self.bounds[i], self.bounds[i + 1]), slice(queries.bounds[j], queries.bounds[j + 1])
            added = mine[a, None] * theirs[None, b]
            if added.shape == out.shape:  # every row and query has the term
                out += added
            elif added.shape[1] == queries.rows:
                out[self.row[a]] += added
            else:
                out[np.ix_(self.row[a], queries.row[b])] += added
        return np.minimum(np.maximum(out, -LONG - 1), LONG) if kind is object else out


def blocks(vectors: pa.Array, rows: int) -> list[tuple[int, Postings]]:
    """Postings of every run of `rows` vectors, and the place of its first."""
    n = len(vectors)
    row, term, weight = weights(vectors)
    starts = range(0, n, rows)
    cuts = np.searchsorted(row, [*starts, n])
    return [
        (at, Postings(min(rows, n - at), row[a:b] - at, term[a:b], weight[a:b]))
        for at, a, b in zip(starts, cuts[:-1], cuts[1:])
    ]


def best(scores: np.ndarray, own: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every column the places and scores of its `k` best rows, the first among equals; `own` names entries that do
    not count."""
    n = len(scores)
    skip: dict[int, list[int]] = {}
    for r, q in own:
        skip.setdefault(q, []).append(r)
    first = max(n - k - max((len(x) for x in skip.values()), default=0), 0)
    if scores.dtype == object:
        picked = [np.array(sorted(range(n), key=lambda i, q=q: (-scores[i, q], i))[: n - first], np.int64) for q in range(scores.shape[1])]
    else:
        # One integer per entry holds the score and, below it, the place: no ties are left.
        keys = np.ascontiguousarray(scores.T).astype(np.int64) * n + np.arange(n - 1, -1, -1)
        top = np.argpartition(keys, first, axis=1)[:, first:]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(keys, top, 1), axis=1), 1)
        picked = list(top)
    out = []
    for q, places in enumerate(picked):
        if q in skip:
            places = places[~np.isin(places, skip[q])]
        places = places[:k]
        out.append((places, scores[places, q]))
    return out


def search_tile(seeking: pa.Table, offered: pa.Table, k: int = K) -> pa.Table:
    """The `k` best candidates of each query of one tile, in order of score and id."""
    names = ["query_row", "query_id", "vec_id", "row_no", "score"]
    if not len(seeking) or not len(offered):
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    offered = offered.sort_by([("vec_id", "ascending"), ("place", "ascending")])  # null ids come last
    row_no = offered["place"].to_numpy()
    places = {int(r): i for i, r in enumerate(row_no)}
    query_rows = seeking["row_no"].to_numpy()
    kept: list[list] = [[] for _ in query_rows]
    queries = blocks(seeking["vector"], BLOCK_QUERIES)
    for at, candidates in blocks(offered["offered"], BLOCK_ROWS):
        for start, block in queries:
            own = [(places[r] - at, q) for q, r in enumerate(query_rows[start : start + block.rows].tolist()) if at <= places.get(r, -1) < at + candidates.rows]
            for q, (where, scores) in enumerate(best(candidates.scores(block), own, k)):
                # Later blocks hold later places, so the sort keeps the order among equal scores.
                merged = kept[start + q] + [(int(s), int(p) + at) for p, s in zip(where, scores)]
                kept[start + q] = sorted(merged, key=lambda x: -x[0])[:k]
    query = np.repeat(np.arange(len(kept)), [len(x) for x in kept])
    found = np.array([p for x in kept for _, p in x], np.int64)
    scores = [s for x in kept for s, _ in x]
    return pa.table(
        [
            pa.array(query_rows[query]),
            seeking["query_id"].take(pa.array(query)),
            offered["vec_id"].take(pa.array(found)),
            pa.array(row_no[found]),
            pa.array(scores, pa.int64()),
        ],
        names=names,
    )


def search(
    table: DataFrame, is_query: Column, k: int = K, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS
) -> DataFrame:
    """query_id, rank, vec_id and score: the `k` best rows for every row of `table` (vec_id, embedding) that is a query."""
    rows = table.where(usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = written(rows.withColumn("row_no", F.monotonically_increasing_id()), "vectors")
    n, seeking = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    candidate_tiles = max(1, -(-n // min(candidate_rows, max(LEAST_CANDIDATES, -(-n // TILES)))))
    query_tiles = max(1, -(-seeking // query_rows))
    place = lambda salt, tiles: F.pmod(F.xxhash64("row_no", F.lit(salt)), F.lit(tiles)).cast("int")
    every = lambda tiles: F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    queries = rows.where("is_query").select(
        F.col("vec_id").alias("query_id"), "vector", "row_no", place("query", query_tiles).alias("q"), every(candidate_tiles).alias("c")
    )
    # Names of its own for the other side: a cogroup drops columns that both sides share by origin.
    offered = rows.select("vec_id", F.col("vector").alias("offered"), F.col("row_no").alias("place"), place("candidate", candidate_tiles).alias("c"), every(query_tiles).alias("q"))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_tile(left, right, k)

    found = queries.groupBy("q", "c").cogroup(offered.groupBy("q", "c")).applyInArrow(
        work, "query_row long, query_id long, vec_id long, row_no long, score long"
    )
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row_no")]
    return top_per_group(found, ["query_row"], order, k, "rank").select("query_id", "rank", "vec_id", "score")
