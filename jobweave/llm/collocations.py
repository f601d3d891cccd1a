"""Phrase collocations, counted in HAT-tries.

Texts (A-Z lower-cased) are cut into pieces at `[.,;:!?\\x0A-\\x0D]` and pieces into words at blanks and tabs. A task
numbers the words it meets and puts the window that starts at each word (up to `most` words, ending with its piece)
into a HAT-trie for the language: a shallow trie over word numbers whose leaves are hash containers of the rest of
the window; a container of over `BURST` entries bursts into a trie node. When the tries hold over `ENTRIES` windows,
whole subtrees, the largest first, are spilled as sorted runs (language, first words, further words, count). The runs
are partitioned by ranges of window prefixes, sorted, and merged in one reading: windows that share their first
k words are neighbours there, so every phrase's count is the sum of a stretch.

Four streams over the texts count words, pairs, triples, and phrases of four or more words. A phrase is found `least`
times only if all shorter ones inside it are, so a stream ends its windows at rarer words and, from the triples on, at
rarer pairs or triples. It knows the others by a table of `BITS` bits, of that size for any corpus: a rare phrase
that shares a bit costs work and changes nothing, as counts are compared with `least` in the end.

Of the phrases found `least` times, those whose words stand inside a longer one found as often are dropped. A cut after
the first k words scores floor(1000 * a * n / (l * r)) with the counts a, l, r of the phrase and its two parts and
the n words of the language, in decimals of 38 digits; the lowest-scoring cut counts (then the smallest k).

Scale: a task's memory is bounded by `ENTRIES`, `WORDS`, `CHUNK` and `BUFFER`, whatever the texts. Copies add up in a task's trie
before anything is shuffled; a prefix that holds many windows spans several range partitions, whose sums at the
boundaries are added at the end. Runs are written before they are partitioned, so a lost executor costs no counting.
The best phrases of a language are found in two rounds over parts of it.

Defined results: null and empty texts have no words; a null language is `und`; repeated rows count each;
equal scores go by count, then by the phrase in UTF-8 order; an empty table gives an empty one. A text is read in
chunks of words, never cut. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_per_group
from .common import written

LEAST = 100
LONGEST = 5
TOP = 2000
UNKNOWN_LANG = "und"
BURST = 8_192
ENTRIES = 1 << 20
WORDS = 1 << 20
WORD_BITS = 21  # of a word's number: the words met, and those of one chunk more
CHUNK = 1 << 20
BUFFER = 1 << 20
BITS = 1 << 27
RUN_ROWS = 1 << 15
ID = 4  # bytes of a word number

# Bytes: A-Z folded, everything that ends a piece made a full stop, which no word holds.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x2E if chr(c) in ".,;:!?" or 0x0A <= c <= 0x0D else 0x20 if c == 9 else c for c in range(256)
)
END = b"."


class Leaf(dict):
    """Hash container: rest of a window -> count."""


class Branch(dict):
    """Trie node: word number -> Branch or Leaf."""


class HatTrie:
    """Counts of windows, given as `width` word numbers of `ID` bytes each."""

    def __init__(self, width: int, burst: int = BURST):
        self.root, self.size, self.burst, self.deepest = Branch(), 0, burst, (width - 1) * ID

    def add(self, counts: dict[bytes, int]) -> None:
        for key, n in counts.items():
            parent, step = self.root, key[:ID]
            node, at = parent.get(step), ID
            while type(node) is Branch:
                parent, step = node, key[at : at + ID]
                node, at = parent.get(step), at + ID
            if node is None:
                node = parent[step] = Leaf()
            rest = key[at:]
            if rest in node:
                node[rest] += n
                continue
            node[rest] = n
            self.size += 1
            if len(node) > self.burst and at <= self.deepest:
                parent[step] = _burst(node)

    def spill(self, keep: int) -> Iterator[dict[bytes, int]]:
        """Whole subtrees, the largest first, until at most `keep` windows are left."""
        sizes = sorted(((sum(1 for _ in _windows(node, b"")), step) for step, node in self.root.items()), reverse=True)
        run: dict[bytes, int] = {}
        for n, step in sizes:
            if self.size <= keep:
                break
            run.update(_windows(self.root.pop(step), step))
            self.size -= n
            if len(run) >= RUN_ROWS:
                yield run
                run = {}
        if run:
            yield run


def _burst(leaf: Leaf) -> Branch:
    out = Branch()
    for rest, n in leaf.items():
        child = out.get(rest[:ID])
        if child is None:
            child = out[rest[:ID]] = Leaf()
        child[rest[ID:]] = n
    return out


def _windows(node: Branch | Leaf, before: bytes) -> Iterator[tuple[bytes, int]]:
    for step, found in node.items():
        if type(node) is Leaf:
            yield before + step, found
        else:
            yield from _windows(found, before + step)


def window_counts(columns: list[np.ndarray]) -> dict[bytes, int]:
    """Windows as bytes, and how often each occurs."""
    if len(columns) * WORD_BITS < 64:
        packed = columns[0].astype(np.int64)
        for c in columns[1:]:
            packed = packed << WORD_BITS | c
        packed, n = np.unique(packed, return_counts=True)
        columns = [packed >> (WORD_BITS * j) & ((1 << WORD_BITS) - 1) for j in reversed(range(len(columns)))]
    keys = np.stack(columns, axis=1).astype(">u4").reshape(-1).view(f"V{ID * len(columns)}").tolist()
    return dict(zip(keys, n.tolist())) if len(columns) * WORD_BITS < 64 else Counter(keys)


def pair_key(first, second):
    """Hash of a phrase and a further word from the hashes of both; numpy integers."""
    return first ^ ((second << np.uint64(23)) | (second >> np.uint64(41)))


def pair_key_column(first: Column, second: Column) -> Column:
    return first.bitwiseXOR(F.shiftleft(second, 23).bitwiseOR(F.shiftrightunsigned(second, 41)))


class Words(dict):
    """Numbers from 1 of the words of one language, in the order they are met; 0 ends a piece and stands for words
    that the table of bits lacks."""

    def __init__(self, lang: str, known: np.ndarray | None):
        super().__init__()
        self.known, self.seed = known, xxhash.xxh64_intdigest(lang.encode(), 42)
        self.clear()

    def clear(self) -> None:
        super().clear()
        self[END] = 0
        self.words: list[bytes | None] = [None]
        self.hashes = [0]

    def __missing__(self, word: bytes) -> int:
        number = len(self.words)
        if self.known is not None:
            h = xxhash.xxh64_intdigest(word, self.seed)
            if not self.known[(h & (BITS - 1)) >> 3] >> (h & 7) & 1:
                self[word] = 0
                return 0
            self.hashes.append(h)
        self[word] = number
        self.words.append(word)
        return number


class Counting:
    """Windows of one language in one task. `grams` knows the phrases of `order` words that a window may hold."""

    def __init__(self, lang: str, least: int, most: int, words: np.ndarray | None, grams: np.ndarray | None, order: int = 0):
        self.lang, self.least, self.most, self.grams, self.order = lang, least, most, grams, order
        self.words, self.trie = Words(lang, words), HatTrie(most)
        self.waiting: list[np.ndarray] = []

    def read(self, text: bytes) -> Iterator[pa.RecordBatch]:
        """Take in all words of `text`, in chunks that end between words; windows are counted `BUFFER` words at a time."""
        at = 0
        while at < len(text):
            end = len(text) if len(text) - at <= CHUNK else text.find(b" ", at + CHUNK)
            end = len(text) if end < 0 else end
            tokens = text[at:end].replace(END, b" . ").split()
            self.waiting.append(np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens)))
            at = end
            if sum(map(len, self.waiting)) > BUFFER:
                self.count()
            if len(self.words) > WORDS:
                self.count()
                yield from self.spill(0)
                before = [self.words.words[i] if i else END for x in self.waiting for i in x.tolist()]
                self.words.clear()
                self.waiting = [np.fromiter(map(self.words.__getitem__, before), np.int32, len(before))]
        self.waiting.append(np.zeros(1, np.int32))

    def count(self, last: bool = False) -> None:
        """Put the windows that begin in the waiting words into the trie. The last words wait for their windows' ends."""
        numbers = np.concatenate([*self.waiting, np.zeros(self.most - 1 if last else 0, np.int32)]) if self.waiting else np.zeros(0, np.int32)
        n = max(0, len(numbers) - self.most + 1)
        self.waiting = [] if last else [numbers[n:]]
        if not n:
            return
        alive = numbers[:n] > 0
        columns = [np.where(alive, numbers[:n], 0)]
        if self.grams is not None:
            hashes = np.array(self.words.hashes, np.uint64)[numbers]
            key = hashes[: len(hashes) - self.order + 1]
            for j in range(1, self.order):
                key = pair_key(key, hashes[j : len(key) + j])
            key = key & np.uint64(BITS - 1)
            known = (self.grams[key >> np.uint64(3)] >> (key & np.uint64(7)).astype(np.uint8)) & 1 > 0
        started = alive
        for j in range(1, self.most):
            alive = alive & (numbers[j : n + j] > 0)
            if self.grams is not None and j >= self.order - 1:
                alive &= known[j - self.order + 1 : n + j - self.order + 1]
            if j == self.least - 1:
                started = alive
            columns.append(np.where(alive, numbers[j : n + j], 0))
        columns = [c[started] for c in columns]
        if len(columns[0]):
            self.trie.add(window_counts(columns))

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Spill subtrees until at most `keep` windows are left, each run in the order of its words."""
        words = pa.array(self.words.words, pa.binary())
        for run in self.trie.spill(keep):
            numbers = np.frombuffer(b"".join(run), ">u4").reshape(-1, self.most).astype(np.int32)
            column = [words.take(pa.array(numbers[:, j])).cast(pa.string()) for j in range(self.most)]
            head = pc.binary_join_element_wise(*column[: self.least], " ")
            names = ["head", *(f"w{j + 1}" for j in range(self.least, self.most))]
            table = pa.table([head, *column[self.least :]], names=names).append_column("n", pa.array(run.values(), pa.int64()))
            table = table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in names], null_placement="at_start"))
            table = table.add_column(0, "lang", pa.array([self.lang] * len(table)))
            yield from table.combine_chunks().to_batches(max_chunksize=RUN_ROWS)


def run_rows(docs: DataFrame, least: int, most: int, words=None, grams=None, order: int = 0, entries: int = ENTRIES) -> DataFrame:
    """Sorted runs of windows of `least` to `most` words: lang, head (the first `least` words), the further words, n."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [None if x is None else np.frombuffer(x.value, np.uint8) for x in (words, grams)]
        counting: dict[str, Counting] = {}
        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                if text:
                    texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                if lang not in counting:
                    counting[lang] = Counting(lang, least, most, *tables, order)
                yield from counting[lang].read(END.join(own).translate(_FOLD))
                while sum(x.trie.size for x in counting.values()) > entries:
                    largest = max(counting.values(), key=lambda x: x.trie.size)
                    yield from largest.spill(largest.trie.size // 2)
        for x in counting.values():
            x.count(last=True)
            yield from x.spill(0)

    schema = "lang string, head string, " + "".join(f"w{j + 1} string, " for j in range(least, most)) + "n long"
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), "text")
    return texts.mapInArrow(work, schema)


def merge(batch: pa.RecordBatch, further: int, at_least: int) -> Iterator[pa.RecordBatch]:
    """lang, phrase, n_words beyond the head, and count for the phrases of a batch of sorted windows: those found often
    enough, and at its ends those that may go on in the neighbouring batch."""
    n = batch["n"].to_numpy()
    columns = [batch["lang"], batch["head"], *(batch[2 + j] for j in range(further))]
    changes = np.zeros(len(n), bool)
    changes[0] = True
    there = np.ones(len(n), bool)
    phrase = None
    for j, column in enumerate(columns):
        differs = pc.invert(pc.equal(pc.fill_null(column[1:], ""), pc.fill_null(column[:-1], "")))
        changes[1:] |= differs.to_numpy(zero_copy_only=False)
        if not j:
            continue
        there &= column.is_valid().to_numpy(zero_copy_only=False)
        phrase = column if phrase is None else pc.binary_join_element_wise(phrase, column, " ")
        starts = np.flatnonzero(changes)
        sums = np.add.reduceat(n, starts)
        kept = sums >= at_least
        kept[[0, -1]] = True
        kept &= there[starts]
        at = pa.array(starts[kept])
        yield pa.RecordBatch.from_arrays(
            [batch["lang"].take(at), phrase.take(at), pa.array(np.full(len(at), j - 1, np.int32)), pa.array(sums[kept])],
            names=["lang", "phrase", "beyond", "n"],
        )


def merged(runs: DataFrame, least: int, most: int, at_least: int = LEAST) -> DataFrame:
    """lang, phrase, n_words and f of all phrases of `least` to `most` words that the runs hold `at_least` times."""
    further = [f"w{j + 1}" for j in range(least, most)]
    keys = ["lang", "head", *further]
    # Windows of one length are no more than a row a run, so a hash will do; longer ones share prefixes.
    placed = runs.repartitionByRange(*keys) if further else runs.repartition(*keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield from merge(batch, len(further), at_least)

    sums = placed.sortWithinPartitions(*keys).mapInArrow(work, "lang string, phrase string, beyond int, n long")
    out = sums.groupBy("lang", "phrase", "beyond").agg(F.sum("n").alias("f")).where(F.col("f") >= at_least)
    return out.select("lang", "phrase", (F.col("beyond") + least).alias("n_words"), "f")


def bit_table(keys: DataFrame) -> bytes:
    """A bit for every `h`, in `BITS` bits."""
    place = F.col("h").bitwiseAND(F.lit(BITS - 1))
    bit = F.expr("shiftleft(1L, CAST(h & 63L AS INT))")
    # At most BITS / 64 rows.
    found = keys.select(F.shiftright(place, 6).alias("i"), bit.alias("bit")).groupBy("i").agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(BITS // 64, "<i8")
    table[found["i"].to_numpy()] = found["bit"].to_numpy()
    return table.tobytes()


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, entries: int = ENTRIES) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, f) of every phrase found `least` times, and (lang, n) with all words of each language."""
    sc = docs.sparkSession.sparkContext
    hashed = lambda word: F.xxhash64(F.col("lang"), word)
    runs = written(run_rows(docs, 1, 1, entries=entries), "word-runs")
    ones = written(merged(runs, 1, 1, least), "words")
    words = sc.broadcast(bit_table(ones.select(hashed(F.col("phrase")).alias("h"))))
    parts = [ones]
    grams = None
    for order in range(2, min(longest, 3) + 1):
        runs_of = run_rows(docs, order, order, words, grams, order - 1, entries)
        parts.append(written(merged(runs_of, order, order, least), "phrases"))
        word = F.split("phrase", " ")
        key = hashed(word[0])
        for j in range(1, order):
            key = pair_key_column(key, hashed(word[j]))
        grams = sc.broadcast(bit_table(parts[-1].select(key.alias("h"))))
    if longest > 3:
        long_runs = written(run_rows(docs, 4, longest, words, grams, 3, entries), "phrase-runs")
        parts.append(written(merged(long_runs, 4, longest, least), "phrases"))
    return reduce(DataFrame.unionByName, parts), runs.groupBy("lang").agg(F.sum("n").alias("n"))


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, entries: int = ENTRIES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the `top` phrases of each language."""
    found, totals = phrase_counts(docs, least, longest, entries)
    words = F.split("phrase", " ")
    candidates = found.where("n_words > 1")
    # A longer phrase found as often leaves one of a word more that is found as often, so that one decides.
    shorter = F.array(_part(words, F.lit(1), F.col("n_words") - 1), _part(words, F.lit(2), F.col("n_words") - 1))
    inside = candidates.where("n_words > 2").select("lang", F.explode(shorter).alias("phrase"), F.col("f").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    open_ones = candidates.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < f").drop("longer")
    # The number of words of a language rides on its phrases under one key of many, so that no language is a hot key.
    cuts = open_ones.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", _part(words, F.lit(1), F.col("k")).alias("first"), _part(words, F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest")
    )
    part = lambda name, f: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    salts = 64
    spread = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int")).join(spread, ["lang", "salt"])
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    cuts = cuts.withColumn("above", wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("below", wide("l") * wide("r"))
    cuts = cuts.withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    best = best.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    ranked = top_per_group(best, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "rank")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
