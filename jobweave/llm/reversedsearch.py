"""Ranked search turned round: the documents stream through an index of the items.

An item's terms go into an inverted index (term -> items). Each task streams its documents: a document's counts of
the terms that the index knows are weighted, scattered over the items that hold the term, and offered to a bounded
heap per item; the tasks' heaps are merged by a top-k per item. With N documents that have a term, L terms in all,
df documents that hold a term, n terms in a document and tf of them the same,

    w = floor(1000 * ln((2 N + 2) / (2 df + 1)))          m = 100 - 90 + (90 n N) div L
    score = sum over the item's terms, once each, of  w * ((1000000000 tf) div (1000 tf + 8 m))

N, L and every df come from a first stream over all documents; nothing is sampled.

Scale: items are taken in blocks whose index has at most `BLOCK_POSTINGS` entries and `BLOCK_ITEMS` items (or one
longer item), so what travels to the tasks is bounded however many items there are; every block costs two streams over
the documents. A task keeps `k` rows an item and scores a bounded slice of documents at a time; documents are never
shuffled, so equal or hot ones do not gather.

Defined results: each row of the items is an item of its own, also with equal or null ids; null and empty texts have
no terms and neither find nor are found; each row of the documents is a document; equal scores go by smaller doc_id,
null ids last. Scores of 0 are left out, so items whose terms no document holds have no rows, nor do empty tables.
Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_per_group
from .common import slices

K = 10
BLOCK_POSTINGS = 1 << 18
BLOCK_ITEMS = 4_096
# Entries of the dense array of scores, and postings met at a time.
SLICE_CELLS = 1 << 18
SLICE_POSTINGS = 1 << 20
EXACT = 2**53

# Bytes: ASCII letters and digits and all bytes of other characters belong to terms, the rest separates them.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


@dataclass
class Index:
    """Terms by number, and for each the items that hold it: those of number t are items[starts[t] : starts[t + 1]]."""

    numbers: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    n_items: int


def _index(held: list[set[bytes]]) -> Index:
    numbers: dict[bytes, int] = {}
    pairs = [(numbers.setdefault(t, len(numbers)), i) for i, found in enumerate(held) for t in sorted(found)]
    pairs.sort()
    term = np.array([t for t, _ in pairs], np.int64)
    return Index(numbers, np.searchsorted(term, np.arange(len(numbers) + 1)), np.array([i for _, i in pairs], np.int64), len(held))


def item_blocks(items: DataFrame, postings: int = BLOCK_POSTINGS, most: int = BLOCK_ITEMS) -> Iterator[tuple[list, Index]]:
    """Ids and index of one block of items after another; the driver holds one block and one partition of items."""
    ids, held, size = [], [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        found = set(terms(row["text"]))
        if not found:
            continue
        if held and (size + len(found) > postings or len(held) == most):
            yield ids, _index(held)
            ids, held, size = [], [], 0
        ids.append(row["item_id"])
        held.append(found)
        size += len(found)
    if held:
        yield ids, _index(held)


def frequencies(docs: DataFrame, numbers) -> DataFrame:
    """term (number) and df, and under -1 and -2 the documents that have a term and the terms of all, for a broadcast
    map of terms; each task passes on its sums."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value
        df = np.zeros(len(number) + 2, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                found = terms(text)
                if found:
                    df[-1] += 1
                    df[-2] += len(found)
                    df[[number[t] for t in set(found) if t in number]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at < len(number), at, at - len(df))), pa.array(df[at])], names=["term", "df"])

    return docs.select("text").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Heaps:
    """The `k` best (score, document) of every item of a block."""

    def __init__(self, n_items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # scores below cannot enter

    def offer(self, scores: np.ndarray, ids: list) -> None:
        """Scores of documents (rows) for items (columns)."""
        row, item = np.nonzero(scores >= self.least)
        for r, i, s in zip(row.tolist(), item.tolist(), scores[row, item].tolist()):
            heap, doc = self.heaps[i], ids[r]
            entry = (s, doc is not None, -doc if doc is not None else 0)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]

    def rows(self, block: int) -> pa.RecordBatch:
        found = [(block, i, -d if named else None, s) for i, heap in enumerate(self.heaps) for s, named, d in heap]
        columns = list(zip(*found)) if found else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["block", "item", "doc_id", "score"])


def document_scores(counts: list[tuple[int, Counter]], index: Index, w: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Scores of documents (terms in all, counts by term number) for every item of the index."""
    doc = np.repeat(np.arange(len(counts)), [len(c) for _, c in counts])
    term = np.fromiter((t for _, c in counts for t in c), np.int64, len(doc))
    tf = np.fromiter((x for _, c in counts for x in c.values()), np.int64, len(doc))
    m = np.array([10 + 90 * n * n_docs // n_terms for n, _ in counts], np.int64)
    value = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
    size = index.starts[term + 1] - index.starts[term]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    cell = np.repeat(doc * index.n_items, size) + index.items[np.repeat(index.starts[term], size) + inside]
    cells = len(counts) * index.n_items
    per_doc = np.bincount(doc, value, len(counts)) if len(doc) else np.zeros(1)
    if per_doc.max(initial=0) < EXACT:  # then sums of doubles are exact
        out = np.bincount(cell, np.repeat(value, size), cells).astype(np.int64)
    else:
        out = np.zeros(cells, np.int64)
        np.add.at(out, cell, np.repeat(value, size))
    return out.reshape(len(counts), index.n_items)


def heaps(docs: DataFrame, block: int, index, w: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """block, item, doc_id and score: the rows that each task's heaps hold in the end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        number, best = own.numbers.get, Heaps(own.n_items, k)
        width = own.starts[1:] - own.starts[:-1]
        for batch in batches:
            ids, counts, cost = [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                found = terms(text)
                known = Counter(map(number, found))
                known.pop(None, None)
                if known:
                    ids.append(doc_id)
                    counts.append((len(found), known))
                    cost.append(max(own.n_items * SLICE_POSTINGS // SLICE_CELLS, int(width[list(known)].sum())))
            for a, b in slices(np.array(cost, np.int64), SLICE_POSTINGS):
                best.offer(document_scores(counts[a:b], own, w, n_docs, n_terms), ids[a:b])
        yield best.rows(block)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return found.mapInArrow(work, "block long, item long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = K, postings: int = BLOCK_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id and score: the `k` documents with the highest scores above 0 for every item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    parts = []
    for number, (ids, index) in enumerate(item_blocks(items, postings)):
        sc = spark.sparkContext
        shared = sc.broadcast(index)
        # At most a row for each term of the block.
        df = {r["term"]: r["df"] for r in frequencies(docs, sc.broadcast(index.numbers)).collect()}
        n_docs, n_terms = df.get(-1, 0), df.get(-2, 0)
        w = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(index.numbers))], np.int64)
        if n_terms:
            found = top_per_group(heaps(docs, number, shared, w, n_docs, n_terms, k), ["block", "item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k, "rank")
            names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {kind}")
            parts.append(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
