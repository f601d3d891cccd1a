"""Nearly the same posting on several boards: MinHash signatures, banding, and Jaccard similarity.

Texts that are equal without regard to case and spacing are one text. Two texts are linked if at least
`LEAST_SIMILARITY` of their distinct `SHINGLE`-word sequences (of shorter texts: the whole text) are common, and a class
is a group of texts connected by links.

1. Every text gets `BANDS` * `ROWS` minima of its hashed shingles. Texts that agree in all minima of a band share
   a bucket; a pair of similarity s shares none with probability (1 - s^ROWS)^BANDS, 5e-6 at 0.8.
2. Buckets are compared by sketch, a byte of every minimum: pairs far below the limit (`LEAST_ESTIMATE`, nine
   standard deviations away) are let go, so that common boilerplate does not chain texts together.
3. The connected groups that remain are verified on the shingles themselves.

Neither step lists pairs: a task takes a bucket or group of at most about `TILE_ROWS` texts, or two such parts of a
larger one, and passes on one row a text (its number of links, and a tree of links), so a hot bucket becomes many
equal tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import materialize
from .components import components

SHINGLE = 5
LEAST_SIMILARITY = 0.8
BANDS, ROWS = 40, 6
LEAST_ESTIMATE = 0.55
TILE_ROWS = 256
# Shingle columns that are compared at a time.
COLUMNS = 8_192


def normal_text(text: Column) -> Column:
    """Text without regard to case and spacing."""
    return strip(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "))


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Hashes of the distinct `n`-word sequences of a normal text; none for an empty one."""
    words = F.filter(F.split(text, " "), lambda w: w != "")

    def hashes(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1)))
        found = F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(words, i, n), " ")))
        return F.when(F.size(words) > 0, F.array_distinct(found)).otherwise(F.array().cast("array<long>"))

    # The words are a variable of the outer function, so that they are split once.
    return F.get(F.transform(F.array(words), hashes), F.lit(0))


def _mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    x = (hashes ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def minima(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """`n` minima, one a column, of every stretch of `hashes`."""
    seeds = np.random.default_rng(0).integers(0, 2**63, n)
    return np.stack([np.minimum.reduceat(_mixed(hashes, int(s)), starts) for s in seeds], axis=1)


def signatures(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, buckets (one for each band) and sketch of the texts (id, hashes) that have a shingle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lists = batch["hashes"]
            starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            found = minima(lists.flatten().to_numpy().view(np.uint64), starts, bands * rows)
            bucket = np.zeros((len(batch), bands), np.uint64)
            for i in range(rows):
                bucket = _mixed(bucket ^ found[:, i::rows], i + 1)
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.ListArray.from_arrays(offsets, pa.array(bucket.view(np.int64).ravel())),
                    pa.array([r.tobytes() for r in (found & np.uint64(255)).astype(np.uint8)], pa.binary()),
                ],
                names=["id", "buckets", "sketch"],
            )

    return texts.where(F.size("hashes") > 0).select("id", "hashes").mapInArrow(work, "id string, buckets array<long>, sketch binary")


def in_parts(rows: DataFrame, by: list[str], tile_rows: int) -> DataFrame:
    """`rows` (id, ...) once for every pair of parts of its group that its own part belongs to; groups of one row go.

    A group has one part for about `tile_rows` rows. `one` and `other` name the pair, `own` the row's part.
    """
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    placed = rows.join(sizes, by).withColumn("_parts", F.ceil(F.col("_n") / tile_rows).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    placed = placed.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return placed.withColumns({"one": F.least("own", "_with"), "other": F.greatest("own", "_with")}).drop("_n", "_parts", "_with")


def group_by_group(rows: DataFrame, by: list[str], work: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """`work` on every group of `rows`. Groups follow one another in a task, so that small ones cost no call each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            starts = [0, *_changes(batch, by), len(batch)]
            if waiting and any(waiting[-1][c][-1].as_py() != batch[c][0].as_py() for c in by):
                yield work(pa.Table.from_batches(waiting))
                waiting = []
            for a, b in zip(starts[:-1], starts[1:]):
                waiting.append(batch.slice(a, b - a))
                if b < len(batch):
                    yield work(pa.Table.from_batches(waiting))
                    waiting = []
        if waiting:
            yield work(pa.Table.from_batches(waiting))

    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def _changes(batch: pa.RecordBatch, by: list[str]) -> list[int]:
    differs = np.zeros(len(batch) - 1, bool)
    for name in by:
        values = batch[name].to_numpy(zero_copy_only=False)
        differs |= values[1:] != values[:-1]
    return (np.flatnonzero(differs) + 1).tolist()


def _compared(group: pa.Table) -> np.ndarray:
    """Which pairs a task compares: those of different parts, or all of one part."""
    own = group["own"].to_numpy()
    if group["one"][0] == group["other"][0]:
        return ~np.eye(len(own), dtype=bool)
    return own[:, None] != own[None, :]


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest place that each place reaches."""
    root = np.arange(len(linked))
    while True:
        reached = np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked))
        found = np.minimum(root, reached)
        found = found[found]
        if (found == root).all():
            return root
        root = found


def _answer(ids: pa.ChunkedArray, linked: np.ndarray) -> pa.RecordBatch:
    """id, root and n (number of links) of the texts that have a link."""
    n = linked.sum(axis=1)
    there = np.flatnonzero(n)
    names = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    root = _roots(linked)[there]
    return pa.RecordBatch.from_arrays([names.take(pa.array(there)), names.take(pa.array(root)), pa.array(n[there])], names=["id", "root", "n"])


def likely(group: pa.Table, least: float = LEAST_ESTIMATE) -> pa.RecordBatch:
    """Links between the texts of a bucket whose sketches agree in a share of at least `least`."""
    sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(len(group), -1)
    linked = _compared(group)
    for i, row in enumerate(sketch):
        linked[i] &= (sketch == row).mean(axis=1) >= least
    return _answer(group["id"], linked)


def common(lists: pa.ListArray) -> np.ndarray:
    """How many values each two of the lists have in common; no list repeats one."""
    _, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(lists), len(lists)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        block = np.zeros((len(lists), COLUMNS), np.float32)
        block[row[a:b], column[a:b] - first] = 1
        out += block @ block.T
    return out.astype(np.int64)


def verified(group: pa.Table, least: float = LEAST_SIMILARITY) -> pa.RecordBatch:
    """Links between the texts of a group whose shingles are common in a share of at least `least`."""
    lists = group["hashes"].combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    both = common(lists)
    either = size[:, None] + size[None, :] - both
    return _answer(group["id"], _compared(group) & (both >= np.maximum(least * either - 1e-9, 1)))


def links(texts: DataFrame, least: float = LEAST_SIMILARITY, tile_rows: int = TILE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Trees of links (id, root) and numbers of links (id, n_links) of texts (id, hashes)."""
    rows = "id string, root string, n long"
    signed = materialize(signatures(texts), "signatures")
    buckets = signed.select("id", F.posexplode("buckets").alias("band", "bucket"))
    tiles = ["band", "bucket", "one", "other"]
    # Most buckets hold one text: sketches are sent only for the others.
    shared = in_parts(buckets, ["band", "bucket"], tile_rows).join(signed.select("id", "sketch"), "id")
    near = group_by_group(shared, tiles, likely, rows)
    groups = components(near.select(F.col("id").alias("a"), F.col("root").alias("b")))
    members = texts.join(groups.withColumnRenamed("node", "id"), "id").withColumnRenamed("root", "group")
    tiles = ["group", "one", "other"]

    def check(group: pa.Table) -> pa.RecordBatch:
        return verified(group, least)

    found = materialize(group_by_group(in_parts(members, ["group"], tile_rows), tiles, check, rows), "links")
    return found.select("id", "root"), found.groupBy("id").agg(F.sum("n").alias("n_links"))


def near_copies(postings: DataFrame, text: Column, least: float = LEAST_SIMILARITY, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Every posting with its class: the class's first posting, how many different texts and boards it has, and to
    how many other texts the posting's own is linked. Postings without text are a class of one text."""
    keyed = postings.select("source_id", "job_id", normal_text(text).alias("text")).withColumn("id", F.md5("text"))
    keyed = materialize(keyed, "normal-texts")
    # Equal texts have equal shingles, so any row's will do.
    texts = keyed.groupBy("id").agg(F.first("text").alias("text")).select("id", shingle_hashes(F.col("text")).alias("hashes"))
    texts = materialize(texts, "shingles")
    trees, numbers = links(texts, least, tile_rows)
    roots = components(trees.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = keyed.select("source_id", "job_id", "id").join(roots.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id"))
    # Counted by board and by text first, so that a class of many copies is a row of each.
    boards = named.groupBy("root", "source_id").agg(F.min("job_id").alias("job_id"))
    boards = boards.groupBy("root").agg(F.min(F.struct("source_id", "job_id")).alias("first"), F.count(F.lit(1)).alias("n_boards"))
    sizes = named.select("root", "id").distinct().groupBy("root").agg(F.count(F.lit(1)).alias("n_texts"))
    classes = boards.join(sizes, "root")
    return (
        named.join(numbers, "id", "left")
        .join(classes, "root")
        .select(
            "source_id", "job_id", F.col("first.source_id").alias("class_source_id"), F.col("first.job_id").alias("class_job_id"),
            "n_texts", "n_boards", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        )
    )
