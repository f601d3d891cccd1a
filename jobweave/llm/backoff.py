"""Stupid-backoff language-model scores of every document under all others, computed relationally.

Words (A-Z lower-cased) and bigrams are counted over the whole corpus, words and bigrams seen once included; no
count is cut and no word is folded into another. A row's own occurrences are taken off the counts it is scored
with, as otherwise every n-gram of the corpus would have been seen and invented words would score best. With
counts c over all other rows and N words in all,

    S(w | v) = c(v w) / c(v)          if c(v w) > 0
             = BACKOFF * c(w) / N     otherwise, if c(w) > 0
             = BACKOFF ** 2 / N       for a word that no other row has,

where the first word of a text starts at c(w) / N, and at BACKOFF / N if no other row has it. A document's score is
the sum of log S. The logarithm of each count is rounded to millionths, so that sums do not depend on their order.

Scale: words are 64-bit hashes of their bytes. Those that make up at least one in `VOCABULARY` of all words, at most
that many, are numbered by falling count, and travel with the tasks as a sorted array of hashes with their counts; any
other word stays its hash, with the sign set (words of equal hash count as one). This changes no score. Every text's
bigrams are exploded into buckets by the bigram's hash, about `BUCKET_ROWS` rows each whatever the corpus has; a row of
the shuffle packs those that a slice of texts has for one bucket. A bucket is counted and its rows are joined with
these counts in one task, which packs the sums of each slice's texts again. What the count of a word without a number is still needed for is joined to the table of all
words on the word's hash. Bigrams that make up about one in `HOT` of a sample, at most that many, are counted exactly by a
pass of their own and scored where the text is read, so that none fills a bucket; the sample decides where they are
added up, not what is. Packing gains less as buckets outnumber the bigrams of a slice, from some hundred terabytes on.

Defined results: null and empty texts have no words and score 0; very long texts are whole, one at a time; rows with
equal ids (null is an id too) are scored each against all other rows, also those of the id, and add up; repeated rows
have seen each other; an empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, written

VOCABULARY = 4_000_000
HOT = 300_000
SAMPLE = 16
BACKOFF = 0.4
MICRO = 1e6
BITS = 22
BUCKET_ROWS = 2_000_000
FLUSH_WORDS = 1 << 21
SLICE_CHARS = 1 << 22
SIGN = -(1 << 63)
RARE = 1 << 23  # set in a packed word that is a place in the list of hashes


def words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []  # bytes: A-Z and white space 9 to 13 and 32 only


def word_counts(docs: DataFrame) -> DataFrame:
    """word (its hash) and n over all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                counts.update(words(text))
            if len(counts) > FLUSH_WORDS:
                yield _pairs(counts)
                counts = Counter()
        if counts:
            yield _pairs(counts)

    def _pairs(counts):
        return pa.RecordBatch.from_arrays([pa.array(_hashes(counts)), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _hashes(distinct) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct)).view(np.int64)


@dataclass
class Vocabulary:
    """Sorted hashes of frequent words, the number of each, the count of each number, and that of all words."""

    hashes: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray
    total: int


def vocabulary(counts: DataFrame, most: int = VOCABULARY) -> Vocabulary:
    total = counts.agg(F.sum("n")).first()[0] or 0
    # At most `most` rows: each holds one in `most` of all words.
    kept = counts.where(F.col("n") * most >= total).toArrow()
    word, n = kept["word"].to_numpy(), kept["n"].to_numpy()
    order = np.lexsort((word, -n))
    word, n = word[order], n[order]
    by_hash = np.argsort(word)
    return Vocabulary(word[by_hash], by_hash.astype(np.int32), n, total)


def rare_words(counts: DataFrame, vocabulary: Vocabulary, most: int = VOCABULARY) -> DataFrame:
    """need (the hash, sign set) and c of all words without a number."""
    rare = counts.where(F.col("n") * most < vocabulary.total)
    return rare.groupBy(F.col("word").bitwiseOR(F.lit(SIGN)).alias("need")).agg(F.sum("n").alias("c"))


def _numbered(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Words of all texts behind one another, how many each text has, a code for each word, and how many codes."""
    found = [words(t) for t in texts]
    size = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.empty(int(size.sum()), dtype=object)
    flat[:] = [w for ws in found for w in ws]
    code, distinct = pd.factorize(flat)
    hashes = _hashes(distinct.tolist())
    place, known = _find(vocabulary.hashes, hashes)
    numbers = hashes | np.int64(SIGN)
    numbers[known] = vocabulary.numbers[place[known]]
    return numbers[code] if len(code) else np.zeros(0, np.int64), size, code, len(distinct)


def _inside(size: np.ndarray) -> np.ndarray:
    """Places of words that have another behind them in their text."""
    last = np.cumsum(size)[size > 0] - 1
    keep = np.ones(int(size.sum()), bool)
    keep[last] = False
    return np.flatnonzero(keep)


def _numbered_bigrams(texts: list[str | None], vocabulary: Vocabulary) -> np.ndarray:
    """Keys v << BITS | w of all bigrams of two numbers."""
    flat, size, _, _ = _numbered(texts, vocabulary)
    at = _inside(size)
    v, w = flat[at], flat[at + 1]
    both = (v >= 0) & (w >= 0)
    return v[both] << BITS | w[both]


def _text_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | None]]]:
    texts = batch["text"].to_pylist()
    for lo, hi in slices(np.array([len(t or "") for t in texts], np.int64), SLICE_CHARS):
        yield lo, texts[lo:hi]


def hot_bigrams(docs: DataFrame, vocabulary: Vocabulary, hot: int = HOT, sample: int = SAMPLE) -> np.ndarray:
    """Sorted keys of bigrams that make up one in `hot` of all bigrams of two numbers in one of `sample` rows."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _text_slices(batch):
                keys, n = np.unique(_numbered_bigrams(texts, shared.value), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    some = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0)
    counts = written(some.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "sampled-bigrams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # At most `hot` rows: each holds one in `hot` of all.
    return np.sort(np.array([r["key"] for r in counts.where(F.col("n") * hot >= total).select("key").collect()], np.int64))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted `keys`, and whether each is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def exact_counts(docs: DataFrame, vocabulary: Vocabulary, keys: np.ndarray) -> np.ndarray:
    """Counts of the bigrams `keys` over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, keys))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, keys = shared.value
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, texts in _text_slices(batch):
                at, known = _find(keys, _numbered_bigrams(texts, vocabulary))
                total += np.bincount(at[known], minlength=len(keys))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["place", "n"])

    out = np.zeros(len(keys), np.int64)
    if len(keys):
        # At most one row for each key.
        rows = docs.select("text").mapInArrow(work, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
        out[rows["place"].to_numpy()] = rows["n"].to_numpy()
    return out


def micro_logs(x: np.ndarray) -> np.ndarray:
    return np.round(np.log(x) * MICRO).astype(np.int64)


def micro_log(x: Column) -> Column:
    return F.round(F.log(x) * MICRO).cast("long")


BACK = int(micro_logs(np.array([BACKOFF]))[0])


def _unigram(others: np.ndarray) -> np.ndarray:
    """Logarithms of the counts of words in other rows; that of `BACKOFF` where there are none."""
    return np.where(others > 0, micro_logs(np.maximum(others, 1)), BACK)


def _log_total(vocabulary: Vocabulary) -> int:
    return int(micro_logs(np.array([max(vocabulary.total, 1)]))[0])


def _bigram_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """v << BITS | w for two numbers; a hash, with the sign set, where a word has none."""
    with np.errstate(over="ignore"):
        x = v.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ w.view(np.uint64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = x ^ (x >> np.uint64(32))
    return np.where((v >= 0) & (w >= 0), v << BITS | w, x.view(np.int64) | np.int64(SIGN))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _packed_words(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three bytes a word, and the hashes of the words that have no number."""
    rare = x < 0
    small = np.where(rare, 0, x).astype(np.uint32)
    hashes, place = np.unique(x[rare], return_inverse=True)
    small[rare] = place | RARE
    return np.concatenate([(small >> k & 255).astype(np.uint8) for k in (0, 8, 16)]), hashes


def _packed_counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A byte a count, and those that have more."""
    return np.minimum(x, 255).astype(np.uint8), x[x >= 255]


def _squeezed(*arrays: np.ndarray) -> bytes:
    raw = b"".join(x.tobytes() for x in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


class _Reader:
    """Arrays of squeezed bytes, one behind the other."""

    def __init__(self, packed: bytes) -> None:
        self.raw, self.at = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True), 0

    def take(self, n: int, kind) -> np.ndarray:
        out = np.frombuffer(self.raw, kind, n, self.at)
        self.at += out.nbytes
        return out

    def counts(self, n: int, more: np.ndarray) -> np.ndarray:
        out = self.take(n, np.uint8).astype(np.int64)
        out[out == 255] = more
        return out


def _pack(text: np.ndarray, many: np.ndarray, v: np.ndarray, w: np.ndarray, counts: list[np.ndarray]) -> bytes:
    """Bigrams of one bucket: the texts in rising order, how many each has, the words, and the counts n, nv and nw."""
    (pv, hv), (pw, hw) = _packed_words(v), _packed_words(w)
    small, large = zip(*map(_packed_counts, (np.diff(text, prepend=0), many, *counts)))
    head = np.array([len(v), len(text), len(hv), len(hw), *map(len, large)], np.int64)
    return _squeezed(head, hv, hw, *large, *small, pv, pw)


def _unpack(packed: bytes) -> list[np.ndarray]:
    """text, many, v, w, and the counts n, nv and nw."""
    read = _Reader(packed)
    n, texts, rare_v, rare_w, *large = read.take(9, np.int64).tolist()
    hashes = read.take(rare_v, np.int64), read.take(rare_w, np.int64)
    large = [read.take(x, np.int64) for x in large]
    gaps, many, *counts = (read.counts(length, more) for length, more in zip((texts, texts, n, n, n), large))
    two = []
    for known in hashes:
        low, mid, high = (read.take(n, np.uint8).astype(np.int64) for _ in range(3))
        x = low | mid << 8 | high << 16
        rare = x >= RARE
        x[rare] = known[x[rare] - RARE]
        two.append(x)
    return [np.cumsum(gaps), many, *two, *counts]


def _pack_sums(text: np.ndarray, sums: np.ndarray) -> bytes:
    """Texts in rising order, and a sum for each; its bytes of equal weight stand together."""
    small, large = _packed_counts(np.diff(text, prepend=0))
    return _squeezed(np.array([len(text), len(large)], np.int64), large, small, np.ascontiguousarray(sums.view(np.uint8).reshape(-1, 8).T))


def _unpack_sums(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    read = _Reader(packed)
    n, large = read.take(2, np.int64).tolist()
    more = read.take(large, np.int64)
    text = np.cumsum(read.counts(n, more))
    return text, np.ascontiguousarray(read.take(8 * n, np.uint8).reshape(8, n).T).view(np.int64).reshape(n)


def exploded(docs: DataFrame, vocabulary: Vocabulary, keys: np.ndarray, counts: np.ndarray, buckets: int) -> DataFrame:
    """Rows (bucket, slice, doc_id, bigrams, closing): a slice of texts has these bigrams in a bucket. The one row of a slice
    with `closing` has the ids of its texts instead, and four numbers a text: its words, the sum of what is scored already,
    and the first word with its count where that has no number (0 otherwise)."""
    log_total = _log_total(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, keys, counts))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, keys, of_hot = shared.value
        of_word = vocabulary.counts
        # Of the task and the place in it, so that a repeated task repeats it.
        slice_id = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, texts in _text_slices(batch):
                slice_id += 1
                flat, size, code, codes = _numbered(texts, vocabulary)
                owner = np.repeat(np.arange(len(size)), size)
                # Groups of equal words in a text, and how large each word's is.
                _, group, many = np.unique(owner * (codes + 1) + code, return_inverse=True, return_counts=True)
                own = many[group]
                at = _inside(size)
                _, first, n = np.unique(group[at] * (len(many) + 1) + group[at + 1], return_index=True, return_counts=True)
                at = at[first]
                v, w, nv, nw, text = flat[at], flat[at + 1], own[at], own[at + 1], owner[at]
                key = _bigram_keys(v, w)
                place, is_hot = _find(keys, key)
                done = np.zeros(len(size), np.int64)
                if is_hot.any():
                    h = np.flatnonzero(is_hot)
                    others = of_hot[place[h]] - n[h]
                    context = np.maximum(of_word[v[h]] - nv[h], 1)
                    back = BACK + _unigram(of_word[w[h]] - nw[h]) - log_total
                    value = np.where(others > 0, micro_logs(np.maximum(others, 1)) - micro_logs(context), back)
                    np.add.at(done, text[h], n[h] * value)
                    rest = ~is_hot
                    v, w, n, nv, nw, text, key = (x[rest] for x in (v, w, n, nv, nw, text, key))
                head, head_own = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
                whose, begin = np.flatnonzero(size), (np.cumsum(size) - size)[size > 0]
                plain = flat[begin] >= 0
                done[whose] -= log_total
                done[whose[plain]] += _unigram(of_word[flat[begin[plain]]] - own[begin[plain]])
                head[whose[~plain]], head_own[whose[~plain]] = flat[begin[~plain]], own[begin[~plain]]
                bucket = _bucket(key, buckets)
                order = np.lexsort((text, bucket))
                v, w, n, nv, nw, text, bucket = (x[order] for x in (v, w, n, nv, nw, text, bucket))
                edges = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)]), len(bucket))
                packed = []
                for a, b in zip(edges[:-1], edges[1:]):
                    who, times = np.unique(text[a:b], return_counts=True)
                    packed.append(_pack(who, times, v[a:b], w[a:b], [n[a:b], nv[a:b], nw[a:b]]))
                closing = np.stack([size, done, head, head_own]).tobytes()
                lists = pa.array([None] * len(packed) + [0, len(size)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(bucket[edges[:-1]], slice_id % buckets)),
                        pa.array(np.full(len(packed) + 1, slice_id)),
                        pa.ListArray.from_arrays(lists, batch["doc_id"].slice(lo, len(size))),
                        pa.array([*packed, None], pa.binary()),
                        pa.array([*[None] * len(packed), closing], pa.binary()),
                    ],
                    names=["bucket", "slice", "doc_id", "bigrams", "closing"],
                )

    schema = f"bucket long, slice long, doc_id array<{kind}>, bigrams binary, closing binary"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def parts(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (slice, bucket, text, need, own, times, sums, doc_id, closing). With need: for a text of the slice the logarithm
    of the count of that word, less `own`, is to be added so many times. With sums: what one bucket adds to the texts of
    the slice. With closing: as in `exploded`."""
    log_total = _log_total(vocabulary)
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary.counts)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["slice", "bucket", "text", "need", "own", "times", "sums", "doc_id", "closing"]
    types = [*[pa.int64()] * 6, pa.binary()]

    def made(n: int, doc, closing: bytes | None = None, **columns) -> pa.RecordBatch:
        arrays = [pa.array(columns[x], t) if x in columns else pa.nulls(n, t) for x, t in zip(names, types)]
        return pa.RecordBatch.from_arrays([*arrays, doc, pa.array([closing] * n, pa.binary())], names=names)

    def needed(slice_id: np.ndarray, text: np.ndarray, need: np.ndarray, own: np.ndarray, times: np.ndarray, doc_type) -> pa.RecordBatch:
        n = len(need)
        return made(n, pa.nulls(n, doc_type), slice=slice_id, text=text, need=need, own=own, times=times)

    def scored_bucket(bucket: int, ids: list[int], packed: list[bytes], doc_type) -> Iterator[pa.RecordBatch]:
        of_word, found = shared.value, [_unpack(x) for x in packed]
        text, many, v, w, n, nv, nw = (np.concatenate(x) for x in zip(*found))
        texts = [len(x[0]) for x in found]
        slice_id = np.repeat(np.array(ids, np.int64), texts)
        place = np.repeat(np.arange(len(many)), many)
        _, group = np.unique(_bigram_keys(v, w), return_inverse=True)
        others = np.bincount(group, weights=n).astype(np.int64)[group] - n
        seen = others > 0
        value = np.where(seen, micro_logs(np.maximum(others, 1)), BACK - log_total)
        at = np.flatnonzero(seen & (v >= 0))
        value[at] -= micro_logs(of_word[v[at]] - nv[at])
        at = np.flatnonzero(~seen & (w >= 0))
        value[at] += _unigram(of_word[w[at]] - nw[at])
        sums = np.zeros(len(many), np.int64)
        np.add.at(sums, place, n * value)
        at = np.flatnonzero(np.where(seen, v, w) < 0)
        context = seen[at]
        need, own, times = np.where(context, v[at], w[at]), np.where(context, nv[at], nw[at]), np.where(context, -n[at], n[at])
        yield needed(slice_id[place[at]], text[place[at]], need, own, times, doc_type)
        ends = np.cumsum(texts)
        blobs = [_pack_sums(text[e - k : e], sums[e - k : e]) for e, k in zip(ends, texts)]
        yield made(len(ids), pa.nulls(len(ids), doc_type), slice=ids, bucket=[bucket] * len(ids), sums=blobs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, packed, doc_type = None, [], [], None
        for batch in batches:
            doc_type = batch["doc_id"].type
            for i, (bucket, slice_id) in enumerate(zip(batch["bucket"].to_pylist(), batch["slice"].to_pylist())):
                closing = batch["closing"][i].as_py()
                if closing is not None:
                    _, _, head, own = np.frombuffer(closing, np.int64).reshape(4, -1)
                    at = np.flatnonzero(head)
                    yield needed(np.full(len(at), slice_id), at, head[at], own[at], np.ones(len(at), np.int64), doc_type)
                    yield made(1, batch["doc_id"].slice(i, 1), closing, slice=[slice_id])
                    continue
                if bucket != current and packed:
                    yield from scored_bucket(current, ids, packed, doc_type)
                    ids, packed = [], []
                current = bucket
                ids.append(slice_id)
                packed.append(batch["bigrams"][i].as_py())
        if packed:
            yield from scored_bucket(current, ids, packed, doc_type)

    schema = f"slice long, bucket long, text long, need long, own long, times long, sums binary, doc_id {kind}, closing binary"
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(work, schema)


def slice_sums(rows: DataFrame) -> DataFrame:
    """slice, text, doc_id, n_words and value of every text, from rows (slice, sums, doc_id, closing)."""
    kind = rows.schema["doc_id"].dataType.elementType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, text, value, doc, closing = None, [], [], None, None

        def finished() -> pa.RecordBatch:
            size, done, _, _ = np.frombuffer(closing, np.int64).reshape(4, -1)
            total = done.copy()
            np.add.at(total, np.concatenate([*text, np.zeros(0, np.int64)]), np.concatenate([*value, np.zeros(0, np.int64)]))
            columns = [pa.array(np.full(len(size), current)), pa.array(np.arange(len(size))), doc, pa.array(size), pa.array(total)]
            return pa.RecordBatch.from_arrays(columns, names=["slice", "text", "doc_id", "n_words", "value"])

        for batch in batches:
            ids = batch["slice"].to_numpy()
            edges = np.append(np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])[: len(ids)]), len(ids))
            for a, b in zip(edges[:-1], edges[1:]):
                if ids[a] != current:
                    if current is not None:
                        yield finished()
                    current, text, value, doc, closing = ids[a], [], [], None, None
                part = batch.slice(a, b - a)
                for packed in part["sums"].drop_null().to_pylist():
                    who, sums = _unpack_sums(packed)
                    text.append(who)
                    value.append(sums)
                last = part.filter(part["closing"].is_valid())
                if len(last):
                    doc, closing = last["doc_id"].flatten(), last["closing"][0].as_py()
        if current is not None:
            yield finished()

    return rows.repartition("slice").sortWithinPartitions("slice").mapInArrow(work, f"slice long, text long, doc_id {kind}, n_words long, value long")


def scored(docs: DataFrame, most: int = VOCABULARY, hot: int = HOT, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, n_words and score (natural logarithm) of every document."""
    all_words = written(word_counts(docs), "word-counts")
    vocab = vocabulary(all_words, most)
    keys = hot_bigrams(docs, vocab, hot)
    rows = exploded(docs, vocab, keys, exact_counts(docs, vocab, keys), vocab.total // bucket_rows + 1)
    known = written(parts(rows, vocab), "score-parts")
    sums = slice_sums(known.where(F.col("need").isNull()).select("slice", "sums", "doc_id", "closing"))
    needed = known.where(F.col("need").isNotNull()).select("slice", "text", "need", "own", "times")
    left = F.col("c") - F.col("own")
    more = (F.col("times") * F.when(left > 0, micro_log(left)).otherwise(BACK)).alias("value")
    needed = needed.join(rare_words(all_words, vocab, most), "need").select("slice", "text", more)
    by_text = sums.unionByName(needed, allowMissingColumns=True).groupBy("slice", "text")
    found = by_text.agg(F.max("doc_id").alias("doc_id"), F.sum("n_words").alias("n_words"), F.sum("value").alias("value"))
    return found.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), (F.sum("value") / MICRO).alias("score"))
