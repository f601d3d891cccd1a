"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte trigrams, hashed into `TERMS` columns, and a few style terms (shares of capitals,
symbols, repeated words and the like). Term weights are dampened counts times inverse document frequency,
counted over all documents. A truncated singular value decomposition of a bounded sample of labelled texts
gives the latent space; the sample's vectors and labels are the voters, and are small enough to travel with
the tasks: `VOTERS_PER_LABEL` x 2 vectors of `RANK` numbers. Every document is compared with every voter in
exact blocked matrix products, and its `NEIGHBOURS` nearest vote with the weight of their similarity.

Defined results: texts that are null or hold no word have score 0. Without voters of both labels every
score is the only label seen, or 0. Rows with equal ids are scored each by its text; of labels that
contradict each other for one id, the smallest counts. Very long texts are counted whole, one at a time. Where
more voters are equally near than `NEIGHBOURS` allows, their order, which follows from their ids, decides. An empty
table gives an empty one. Extra columns are no input; they stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import extended, slices, text_bytes, without

TERMS = 2048
RANK = 48
NEIGHBOURS = 24
SHARPNESS = 8
VOTERS_PER_LABEL = 1500
SLICE_BYTES = 1 << 20
SLICE_ROWS = 512
STYLE_WEIGHT = 0.35

STYLE = (
    "capitals", "digits", "symbols", "punctuation", "bars", "distinct", "repeated", "lines", "word_length", "length",
)
WIDTH = TERMS + len(STYLE)
_CAPITAL, _LETTER, _DIGIT, _SYMBOL, _POINT, _BAR = 1, 2, 4, 8, 16, 32


def _classes() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.isalpha():
            kinds[b] |= _LETTER
        if b < 128 and c.isupper():
            kinds[b] |= _CAPITAL
        if b < 128 and c.isdigit():
            kinds[b] |= _DIGIT
        if c in "#*$%&<>@^~=+\\{}[]_":
            kinds[b] |= _SYMBOL
        if c in "!?.,;:":
            kinds[b] |= _POINT
        if c == "|":
            kinds[b] |= _BAR
    return kinds


_KINDS = _classes()


def _word_style(text: bytes) -> tuple[float, ...]:
    words = text.split()
    if not words:
        return (0.0, 0.0, 0.0, 0.0, 0.0)
    lines = [line for line in text.split(b"\n") if line.strip()]
    n = len(words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    return (
        len(set(words)) / n, same / n, 1 - len(set(lines)) / len(lines),
        min(1.0, sum(map(len, words)) / n / 20), min(1.0, np.log1p(n) / 10),
    )


def term_counts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, counts) for runs of texts: rows of `TERMS` trigram counts and the style terms."""
    data, offsets = text_bytes(texts)
    lengths = np.diff(offsets)
    for lo, hi in slices(np.maximum(lengths, SLICE_BYTES // SLICE_ROWS), SLICE_BYTES):
        part, n = data[offsets[lo] : offsets[hi]], hi - lo
        out = np.zeros((n, WIDTH), np.float32)
        owner = np.repeat(np.arange(n, dtype=np.int64), lengths[lo:hi])
        if len(part) > 2:
            wide = part.astype(np.uint32)
            code = (wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA6B) + wide[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(21)
            inside = owner[2:] == owner[:-2]
            cells = owner[:-2][inside] * TERMS + code[inside]
            out[:, :TERMS] = np.bincount(cells, minlength=n * TERMS).reshape(n, TERMS)
        kinds = _KINDS[part]
        size = np.maximum(lengths[lo:hi], 1)
        for j, kind in enumerate((_CAPITAL, _DIGIT, _SYMBOL, _POINT, _BAR)):
            share = np.bincount(owner, weights=(kinds & kind) > 0, minlength=n) / size
            out[:, TERMS + j] = np.sqrt(share)
        raw = part.tobytes()
        base = offsets[lo]
        for i in range(n):
            out[i, TERMS + 5 :] = _word_style(raw[offsets[lo + i] - base : offsets[lo + i + 1] - base])
        yield lo, hi, out


def document_frequency(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each hashed trigram occurs: over all of `docs`, added up in the
    tasks and then cell by cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(TERMS, np.int64)
        for batch in batches:
            for lo, hi, counts in term_counts(batch[text]):
                n += hi - lo
                df += (counts[:, :TERMS] > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, TERMS), pa.int32()), pa.array([n, *df], pa.int64())], names=["term", "n"])

    sums = docs.select(text).mapInArrow(work, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in sums}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(TERMS)], np.int64)


@dataclass
class Voters:
    """The latent space (`WIDTH` x rank), and the labelled sample in it."""

    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts)
    out[:, :TERMS] *= idf
    out[:, :TERMS] /= np.maximum(np.linalg.norm(out[:, :TERMS], axis=1, keepdims=True), 1e-9)
    out[:, TERMS:] = counts[:, TERMS:] * STYLE_WEIGHT
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def fit(counts: np.ndarray, labels: list[int], n_docs: int, df: np.ndarray, rank: int = RANK) -> Voters:
    """Voters from rows of term counts."""
    idf = (np.log((1 + n_docs) / (1 + df)) + 0.1).astype(np.float32)
    if not len(counts):
        return Voters(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    rows = weighted(counts, idf)
    # Right singular vectors through the smaller Gram matrix.
    values, sides = np.linalg.eigh((rows.T @ rows).astype(np.float64))
    space = sides[:, ::-1][:, : min(rank, len(counts))].astype(np.float32)
    return Voters(idf, np.ascontiguousarray(space), _unit(rows @ space), np.array(labels, np.float32))


def scores(voters: Voters, texts: pa.Array, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of the similarity-weighted votes for label 1, with the labels' numbers evened out."""
    out = np.zeros(len(texts))
    kinds = np.unique(voters.labels)
    k = min(neighbours, len(voters.labels))
    for lo, hi, counts in term_counts(texts):
        wordless = counts[:, TERMS + STYLE.index("word_length")] == 0
        if len(kinds) < 2:
            out[lo:hi] = np.where(wordless, 0.0, float(kinds[0]) if len(kinds) else 0.0)
            continue
        cosine = _unit(weighted(counts, voters.idf) @ voters.space) @ voters.vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS + 1e-12
        share = np.array([1 / max(1, (voters.labels == v).sum()) for v in (0, 1)])
        label = voters.labels[near].astype(int)
        weight *= share[label]
        out[lo:hi] = np.where(wordless, 0.0, (weight * label).sum(axis=1) / weight.sum(axis=1))
    return np.clip(out, 0.0, 1.0)


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, per_label: int = VOTERS_PER_LABEL) -> tuple[np.ndarray, list[int]]:
    """Term counts and labels of at most `per_label` labelled texts of each label: those with the smallest hashes
    of their ids, and of texts with one id the one with the smallest hash. Texts are counted in the tasks, so
    what reaches the driver is of one size however long they are."""
    known = labels.where(usable & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    chosen = {}
    for value in (0, 1):
        for r in ids.where(F.col("quality") == value).orderBy("h", "doc_id").limit(per_label).collect():
            chosen[r["doc_id"]] = value
    if not chosen:
        return np.zeros((0, WIDTH), np.float32), []
    mine = docs.where(F.col("doc_id").isin(list(chosen))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    mine = mine.withColumn("h", F.xxhash64("text"))
    first = {(r["doc_id"], r["h"]) for r in mine.groupBy("doc_id").agg(F.min("h").alias("h")).collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch["doc_id"].to_pylist(), batch["h"].to_pylist())
            batch = batch.filter(pa.array([k in first for k in keys], pa.bool_()))
            for lo, hi, counts in term_counts(batch["text"]):
                packed = pa.array([row.tobytes() for row in counts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), packed], names=["doc_id", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = mine.mapInArrow(count, f"doc_id {kind}, counts binary").groupBy("doc_id").agg(F.min("counts").alias("counts")).collect()
    rows = sorted((r["doc_id"], bytes(r["counts"])) for r in rows)
    return np.stack([np.frombuffer(c, np.float32) for _, c in rows]), [chosen[i] for i, _ in rows]


def learn(docs: DataFrame, labels: DataFrame, usable: Column) -> Voters:
    """Voters from the labels of usable ids (a condition on doc_id), document frequencies from all documents."""
    n, df = document_frequency(docs)
    counts, marks = training_rows(docs, labels, usable)
    return fit(counts, marks, n, df)


def with_quality(docs: DataFrame, voters: Voters, keep: float | None = None) -> DataFrame:
    """All columns of `docs` with quality_score, which replaces a column so named; with `keep`, the columns of
    `docs`, unchanged, and the rows that score at least that."""
    new = [("quality_score", "double")] if keep is None else []
    docs = without(docs, *(name for name, _ in new))
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(shared.value, batch["text"])
            yield batch.append_column("quality_score", pa.array(found)) if keep is None else batch.filter(pa.array(found >= keep))

    return docs.mapInArrow(work, extended(docs, *new))
