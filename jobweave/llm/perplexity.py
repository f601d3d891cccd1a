"""Quality rules with an n-gram perplexity band for each language.

Base rules count words, symbols, repeated lines and repeated word windows of whole texts. The perplexity is
that of a modified Kneser-Ney model of order 3 over characters, one model for each language (null is a language
of its own). Every code point is a symbol of its own, none is folded into another; texts are framed by a symbol
that no character has. N-grams are counted over all documents: each task adds up its own sparsely and passes
on what it has before that grows beyond `HELD` n-grams, Spark adds the rest. Discounts, continuation counts
and back-off weights are those of Chen and Goodman, from aggregates by language, by symbol and, for what a
middle symbol decides, by ranges of middle symbols; neither the driver nor a task sees a whole model.

A text is read by the n-grams that other texts of its language hold: a trigram that stands in no other backs off,
and so does its pair, or else a rare script would vouch for itself. The trigrams seen most often, at most
`HEAD` of all languages, travel to the tasks as sorted arrays of 64-bit hashes with the values beside them, and a
lookup is a binary search; the others are joined. Which way a trigram goes changes no value.

A text's log perplexity is the mean over all of its symbols under the model of its own language, so every part of it
weighs by its length, and a text in another language than its own is read by the wrong model.

A document is judged against the band of its language, which follows from all of its documents that pass the
base rules: the median of the log perplexity, less `LOWER_BAND` and plus `UPPER_BAND` times the median
deviation on that side, each no less than `LEAST_SPREAD`. A short text strays further, so the band is
widened by `SHORT` / sqrt(symbols).

Defined results: null and texts without words fail the base rules; null has only zero counts. Rows with equal ids
are judged each by its text. An empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes, written

SYMBOLS = 128
ORDER = 3
LOWER_BAND, UPPER_BAND = 6.0, 1.2
LEAST_SPREAD = 0.005
SHORT = 2.2
SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096
HELD = 1 << 20
HEAD = 1 << 19
MIDDLES = 64
WINDOW_WORDS = 5
_WORD = re.compile("[^\x20\x09-\x0d]+")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


FRAME = 0
_CLASS = range(1, 0x110001)  # symbols of the code points
ALPHABET = len(_CLASS) + 1

# A code holds the low 7 bits of its symbols side by side, the last one lowest, and from bit 21 on their high 14 bits;
# so the code of symbols below 128 is their number to the base of 128.
_LOW, _HIGH, _HIGH_FROM = 7, 14, 21


def base_counts(texts: pa.Array) -> pd.DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text."""
    rows = []
    for text in texts.to_pylist():
        words = _WORD.findall(text or "")
        if not words:
            rows.append((0, 0, _count_symbols(text or ""), 0, 0))
            continue
        lines = [line for line in text.split("\n") if _WORD.search(line)]
        repeated = _repeat_words(np.fromiter(map(hash, words), np.int64, len(words)))
        rows.append((len(words), sum(map(len, words)), _count_symbols(text), len(lines) - len(set(lines)), repeated))
    return pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], dtype=np.int64)


def _count_symbols(text: str) -> int:
    return int(_SYMBOL[np.frombuffer(text.encode(), np.uint8)].sum())


def _repeat_words(word: np.ndarray) -> int:
    """Words covered by windows that occur twice or more, the first occurrence included; words and windows
    are compared by 64-bit hashes."""
    n = len(word) - WINDOW_WORDS + 1
    if n < 2:
        return 0
    window = np.zeros(n, np.uint64)
    for k in range(WINDOW_WORDS):
        window = (window ^ (window >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word[k : k + n].view(np.uint64)
    order = np.argsort(window)
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n + 1, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    covered = np.zeros(len(word) + 1, np.int64)
    covered[at] += 1
    covered[at + WINDOW_WORDS] -= 1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def symbol_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of every symbol and of the end frame after the two symbols before it, and the text each belongs
    to, from UTF-8."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    lengths = np.diff(begun[offsets])
    framed = np.full(len(points) + 3 * len(lengths), FRAME, np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    framed[np.arange(len(points)) + 3 * owner + 2] = points + _CLASS.start
    low, high = framed & (SYMBOLS - 1), framed >> _LOW
    codes = (low[:-2] * SYMBOLS + low[1:-1]) * SYMBOLS + low[2:]
    codes |= ((high[:-2] << 2 * _HIGH) + (high[1:-1] << _HIGH) + high[2:]) << _HIGH_FROM
    mine = np.repeat(np.arange(len(lengths)), lengths + 1)
    return codes[np.arange(len(mine)) + 2 * mine], mine


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Trigram codes of one slice of texts; those of a long text come in several arrays."""
    if len(offsets) > 2 or len(data) <= SLICE_BYTES:
        yield symbol_codes(data, offsets)[0]
        return
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    for start in range(0, len(begins), SLICE_BYTES):
        first, end = max(start - 2, 0), start + SLICE_BYTES
        part = data[begins[first] : begins[end] if end < len(begins) else len(data)]
        codes, _ = symbol_codes(part, np.array([0, len(part)]))
        yield codes[start - first : -1 if end < len(begins) else None]


def last(codes, order: int):
    """Codes of the last `order` symbols; of arrays and columns alike."""
    keep = (1 << _LOW * order) - 1 | ((1 << _HIGH * order) - 1) << _HIGH_FROM
    return codes.bitwiseAND(F.lit(keep)) if isinstance(codes, Column) else codes & keep


def before(codes, order: int = ORDER):
    """Codes of all symbols but the last, of n-grams of up to `order`."""
    low = (1 << _LOW * order) - 1
    if isinstance(codes, Column):
        high = F.shiftleft(F.shiftright(codes, _HIGH_FROM + _HIGH), _HIGH_FROM)
        return F.shiftright(codes.bitwiseAND(F.lit(low)), _LOW).bitwiseOR(high)
    return (codes & low) >> _LOW | codes >> _HIGH_FROM + _HIGH << _HIGH_FROM


def _name(lang: str | None) -> str:
    """A language, null included, as text."""
    return "" if lang is None else "=" + lang


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of all parts, and the sums of their counts."""
    codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(back, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def count_trigrams(docs: DataFrame, held: int = HELD) -> DataFrame:
    """name (of the language), gram, n over all texts."""

    def batch(sums: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for name, parts in sums.items():
            codes, n = _added(parts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["name", "gram", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        size = limit = 0
        for rows in batches:
            langs = rows["lang"].to_pylist()
            for lang in dict.fromkeys(langs):
                data, offsets = text_bytes(rows["text"].filter(pa.array([x == lang for x in langs], pa.bool_())))
                parts = sums.setdefault(_name(lang), [])
                for lo, hi in slices(np.diff(offsets), SLICE_BYTES):
                    for codes in _pieces(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                        parts.append(np.unique(codes, return_counts=True))
                        size += len(parts[-1][0])
            if size > max(held, limit):
                sums = {name: [_added(parts)] for name, parts in sums.items()}
                size = sum(len(parts[0][0]) for parts in sums.values())
                limit = 2 * size
                if size > held:
                    yield from batch(sums)
                    sums, size, limit = {}, 0, 0
        yield from batch(sums)

    parts = docs.select("lang", "text").mapInArrow(work, "name string, gram long, n long")
    return parts.groupBy("name", "gram").agg(F.sum("n").alias("n"))


def hashed(codes: np.ndarray, order: int) -> np.ndarray:
    """64-bit hashes of n-gram codes (a mixer without collisions; codes of an order are below the bit of that order)."""
    x = codes.astype(np.uint64) | np.uint64(1 << 60 + order)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted `keys`, and whether each wanted key is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Model:
    """Sorted n-gram hashes of all orders with log probabilities, and of all contexts with log back-off weights."""

    grams: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray
    symbols: int

    def find(self, codes: np.ndarray, order: int, context: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Values, and whether the n-gram is known."""
        keys, values = (self.contexts, self.weight) if context else (self.grams, self.logp)
        at, known = _find(keys, hashed(codes, order))
        return (np.where(known, values[at], 0.0) if len(keys) else np.zeros(len(codes))), known

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Natural log of p(c | a, b) for every trigram code."""
        unique, back = np.unique(codes, return_inverse=True)
        one, known1 = self.find(last(unique, 1), 1)
        rest, _ = self.find(np.zeros(1, np.int64), 1, context=True)
        p = np.where(known1, one, rest[0] - np.log(self.symbols))
        for order in (2, 3):
            code = last(unique, order)
            value, known = self.find(code, order)
            backoff, _ = self.find(before(code), order, context=True)
            p = np.where(known, value, backoff + p)
        return p[back]


def _discounts(n: list[int]) -> np.ndarray:
    """Discount of counts 0, 1, 2 and 3 or more, from how many n-grams have a count of 1, 2, 3 and 4."""
    if not all(n):
        return np.array([0.0, 0.5, 0.5, 0.5])  # too few n-grams to estimate any
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.01), k * 0.99) for d, k in zip(raw, (1, 2, 3)))])


def _shape(counts: np.ndarray) -> list[int]:
    """How many n-grams have a count of 1, 2, 3 and 4."""
    return [int((counts == k).sum()) for k in range(1, 5)]


def _smoothed(codes: np.ndarray, counts: np.ndarray, shape: list[int], below: np.ndarray):
    """Probability of each n-gram of an order and the weight of its context, from the probability of its last symbols
    one order below; and the contexts with their weights. Contexts are whole."""
    discount = _discounts(shape)[np.minimum(counts, 3)]
    head, place = np.unique(before(codes), return_inverse=True)
    total = np.bincount(place, weights=counts)
    gamma = np.bincount(place, weights=discount) / total
    return (counts - discount) / total[place] + gamma[place] * below, gamma[place], head, gamma


def fit(grams: np.ndarray, n: np.ndarray, symbols: int = SYMBOLS) -> Model:
    """Modified Kneser-Ney from the trigram codes of one language and their counts, in one process; below the first
    order `symbols` symbols are equally likely."""
    pairs, to_pair, n2 = np.unique(last(grams, 2), return_inverse=True, return_counts=True)
    units, to_unit, n1 = np.unique(last(pairs, 1), return_inverse=True, return_counts=True)
    keys, logs, contexts, weights = [], [], [], []
    p, lower = np.full(1, 1 / symbols), np.zeros(len(units), np.int64)
    for order, (codes, counts, up) in enumerate(((units, n1, lower), (pairs, n2, to_unit), (grams, n, to_pair)), start=1):
        p, _, head, gamma = _smoothed(codes, counts, _shape(counts), p[up])
        keys.append(hashed(codes, order))
        logs.append(np.log(p))
        contexts.append(hashed(head, order))
        weights.append(np.log(gamma))
    grams_, logp = np.concatenate(keys), np.concatenate(logs)
    contexts_, weight = np.concatenate(contexts), np.concatenate(weights)
    a, b = np.argsort(grams_), np.argsort(contexts_)
    return Model(grams_[a], logp[a], contexts_[b], weight[b], symbols)


def _levels(rows: pa.Table) -> pa.Table:
    """The trigrams of some middle symbols of a language, all of each, with their values."""
    name, gram, n, n_unit = (rows[c].combine_chunks() for c in ("name", "gram", "n", "n_unit"))
    gram, n, n_unit = (x.to_numpy() for x in (gram, n, n_unit))
    one, two, three = (rows[c][0].as_py() for c in ("shape1", "shape2", "shape3"))
    pairs, first, to_pair, n2 = np.unique(last(gram, 2), return_index=True, return_inverse=True, return_counts=True)
    # The first order has one context, all of whose symbols only the aggregates know.
    discounts, n1 = _discounts(one[:4]), n_unit[first]
    of_all = discounts[1] * one[0] + discounts[2] * one[1] + discounts[3] * (one[4] - one[0] - one[1])
    p1 = (n1 - discounts[np.minimum(n1, 3)] + of_all / ALPHABET) / one[5]
    p2, weight2, *_ = _smoothed(pairs, n2, two[:4], p1)
    p3, weight3, *_ = _smoothed(gram, n, three[:4], p2[to_pair])
    held = np.bincount(to_pair, weights=n).astype(np.int64)[to_pair]
    levels = p3, weight3 * p2[to_pair], weight3 * (weight2 * p1)[to_pair]
    arrays = [name, *map(pa.array, (gram, n, held, *map(np.log, levels)))]
    return pa.table(arrays, names=["name", "gram", "n", "n_pair", "logp", "logp2", "logp1"])


def learn(docs: DataFrame) -> DataFrame:
    """name (of the language), gram, n and n_pair (how often the trigram and its last two symbols occur), logp, and
    logp2 and logp1 where it backs off to the pair and to the symbol: a row for each trigram of all documents."""
    counts = written(count_trigrams(docs), "trigrams")
    pairs = written(counts.groupBy("name", last(F.col("gram"), 2).alias("pair")).agg(F.count("*").alias("n")), "pairs")
    units = written(pairs.groupBy("name", last(F.col("pair"), 1).alias("unit")).agg(F.count("*").alias("n_unit")), "units")

    def shape(table: DataFrame, n: str, to: str) -> DataFrame:
        return table.groupBy("name").agg(F.array(*(F.count_if(F.col(n) == k) for k in range(1, 5)), F.count("*"), F.sum(n)).alias(to))

    shapes = shape(units, "n_unit", "shape1").join(shape(pairs, "n", "shape2"), "name").join(shape(counts, "n", "shape3"), "name")
    middle = F.pmod(F.xxhash64(last(before(F.col("gram")), 1)), F.lit(MIDDLES))
    rows = counts.withColumn("unit", last(F.col("gram"), 1)).join(units, ["name", "unit"]).join(shapes, "name")
    levels = rows.groupBy("name", middle.alias("middle")).applyInArrow(
        _levels, "name string, gram long, n long, n_pair long, logp double, logp2 double, logp1 double"
    )
    return written(levels, "levels")


@dataclass
class Known:
    """Sorted hashes of trigrams of a language, and their values."""

    keys: np.ndarray
    n: np.ndarray
    n_pair: np.ndarray
    logs: np.ndarray  # by level: whole, backed off to the pair, to the symbol


def _head(model: DataFrame, most: int) -> tuple[dict[str, Known], bool]:
    """The trigrams of all languages that occur no less often than some power of 2, `most` at most; and whether they are all."""
    bits = F.length(F.bin("n"))
    sizes = {r["bits"]: r["count"] for r in model.groupBy(bits.alias("bits")).count().collect()}
    total, least = 0, 64
    for size in sorted(sizes, reverse=True):
        total += sizes[size]
        if total > most:
            break
        least = size
    rows = model.where(bits >= least).toArrow()
    names = rows["name"].combine_chunks().dictionary_encode()
    of = names.indices.to_numpy()
    keys = hashed(rows["gram"].to_numpy(), ORDER)
    n, n_pair, *logs = (rows[c].to_numpy() for c in ("n", "n_pair", "logp", "logp2", "logp1"))
    order = np.lexsort((keys, of))
    ends = np.searchsorted(of[order], np.arange(len(names.dictionary) + 1))
    head = {}
    for i, name in enumerate(names.dictionary.to_pylist()):
        mine = order[ends[i] : ends[i + 1]]
        head[name] = Known(keys[mine], n[mine], n_pair[mine], np.stack([x[mine] for x in logs]))
    return head, total <= most


_NONE = Known(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((3, 0)))


def _cells(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes; for each of a text's distinct codes the text, the place of the code and its count in the text."""
    unique, back = np.unique(codes, return_inverse=True)
    cell, k = np.unique(owner * len(unique) + back, return_counts=True)
    text, at = np.divmod(cell, len(unique))
    return unique, text, at, k


def _of_pairs(unique: np.ndarray, text: np.ndarray, at: np.ndarray, k: np.ndarray) -> np.ndarray:
    """How often each cell's text holds the last two symbols of its code."""
    pairs, to_pair = np.unique(last(unique, 2), return_inverse=True)
    _, group = np.unique(text * len(pairs) + to_pair[at], return_inverse=True)
    return np.bincount(group, weights=k).astype(np.int64)[group]


def whole_sums(head: dict[str, Known], names: list[str], data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each text the sum of log probabilities over all its symbols that `head` knows, under its own language's model,
    and its other trigrams."""
    out, others = np.zeros(len(names)), []
    langs = np.array(names, dtype=object)
    for lo, hi in slices(np.maximum(np.diff(offsets), SLICE_BYTES // SLICE_ROWS), SLICE_BYTES):
        part = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        if hi - lo > 1:
            codes, owner = symbol_codes(*part)
        for name in dict.fromkeys(names[lo:hi]):
            if hi - lo > 1:
                mine = (langs[lo:hi] == name)[owner]
                unique, text, at, k = _cells(codes[mine], owner[mine])
            else:
                unique, k = _added([np.unique(x, return_counts=True) for x in _pieces(*part)])
                text, at = np.zeros(len(unique), np.int64), np.arange(len(unique))
            k_pair = _of_pairs(unique, text, at, k)
            model = head.get(name, _NONE)
            place, known = _find(model.keys, hashed(unique, ORDER))
            there = known[at]
            here, own, own_pair = place[at][there], k[there], k_pair[there]
            level = np.where(own_pair == model.n_pair[here], 2, np.where(own == model.n[here], 1, 0))
            out[lo:hi] += np.bincount(text[there], weights=own * model.logs[level, here], minlength=hi - lo)
            others.append((lo + text[~there], unique[at][~there], k[~there], k_pair[~there]))
    of, *columns = (np.concatenate(x) for x in zip(*others)) if others else [np.zeros(0, np.int64)] * 4
    order = np.argsort(of, kind="stable")
    rows = pa.StructArray.from_arrays([pa.array(x[order]) for x in columns], names=["gram", "k", "k_pair"])
    return out, pa.ListArray.from_arrays(pa.array(np.searchsorted(of[order], np.arange(len(names) + 1)), pa.int32()), rows)


def measured(docs: DataFrame, model: DataFrame, most: int = HEAD) -> DataFrame:
    """doc_id, lang, base counts, n_codes and log_perplexity (per symbol) of every row that `model` was learned on."""
    head, all_there = _head(model, most)
    shared = docs.sparkSession.sparkContext.broadcast(head)
    kind = "array<struct<gram: bigint, k: bigint, k_pair: bigint>>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = base_counts(batch["text"])
            names = [_name(x) for x in batch["lang"].to_pylist()]
            data, offsets = text_bytes(batch["text"])
            begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
            sums, others = whole_sums(shared.value, names, data, offsets)
            arrays = [batch["doc_id"], batch["lang"], *(pa.array(counts[c]) for c in counts), pa.array(np.diff(begun) + 1), pa.array(sums), others]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang", *counts, "n_codes", "sums", "others"])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "lang", "text").mapInArrow(
        work,
        f"doc_id {doc_id}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_codes long, sums double, others {kind}",
    )
    total = F.col("sums")
    if not all_there:
        rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "sums")
        name = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), "lang"))
        found = rows.select("row", name.alias("name"), F.inline("others")).join(model, ["name", "gram"])
        log = F.when(F.col("k_pair") == F.col("n_pair"), F.col("logp1")).when(F.col("k") == F.col("n"), F.col("logp2")).otherwise(F.col("logp"))
        rows = rows.join(found.groupBy("row").agg(F.sum(F.col("k") * log).alias("joined")), "row", "left")
        total += F.coalesce("joined", F.lit(0.0))
    return rows.withColumn("log_perplexity", -total / F.col("n_codes")).drop("row", "sums", "others", "joined")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def bands(rows: DataFrame, below: float = LOWER_BAND, above: float = UPPER_BAND) -> DataFrame:
    """lang, lower and upper log perplexity, from all rows that pass the base rules."""
    good = rows.where(~base_failed()).select(F.coalesce("lang", F.lit("")).alias("name"), F.col("lang").isNull().alias("none"), "log_perplexity")
    # The median deviation below the median is its distance from the lower quartile, and so above.
    quartiles = good.groupBy("name", "none").agg(F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000).alias("q"))
    low, mid, high = (F.get("q", i) for i in range(3))
    least = F.lit(LEAST_SPREAD)
    return quartiles.select(
        "name", "none", (mid - below * F.greatest(mid - low, least)).alias("lower"), (mid + above * F.greatest(high - mid, least)).alias("upper")
    )


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts, base_failed, perplexity, its band and kept for every row."""
    rows = written(measured(docs, learn(docs)), "perplexities")
    rows = rows.withColumn("name", F.coalesce("lang", F.lit(""))).withColumn("none", F.col("lang").isNull())
    slack = SHORT / F.sqrt("n_codes")
    inside = (F.col("log_perplexity") >= F.col("lower") - slack) & (F.col("log_perplexity") <= F.col("upper") + slack)
    return rows.join(written(bands(rows), "bands"), ["name", "none"], "left").select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), F.exp("log_perplexity").alias("perplexity"),
        F.exp(F.col("lower") - slack).alias("lower"), F.exp(F.col("upper") + slack).alias("upper"),
        (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
