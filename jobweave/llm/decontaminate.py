"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Texts are cut into words (runs of letters and digits, lower-cased). A seed is a fixed mask over a window of
words: the words under its ones are hashed, those under its zeros are ignored, so that a hit survives
substitutions there. Window hashes of documents are joined with those of the benchmark; each hit gives a
diagonal (place in the document minus place in the item), along which the two word sequences are compared
whole. An overlap is a segment of a diagonal that has at least `MIN_WORDS` words, or the whole of a shorter item, and
at least `MIN_IDENTITY` of them equal; the longest one is returned, its ends not trimmed. With `trimmed`, only the
segment that is best at 1 for an equal word and -`PENALTY` for a different one is looked at, which loses overlaps
with differences near their ends.

No overlap is lost by the seeds at 3/4 equal words or more and `MIN_WORDS` words or more: under every choice of
differences that the rule allows in 13 to 25 words one of `MASKS` hits (searched exhaustively), and a longer
segment contains one of such a length. An item of fewer than `MIN_WORDS` words, d of which may differ, is cut
into 2 d parts, and every choice of d parts is a mask over it as a whole. A place of a document is read under the masks
of a length that the benchmark has if at least d of its parts there are parts of items, which a bit table tells.

Scale: before anything is shuffled, window hashes are tested against a bit table of the benchmark's hashes
of at most 2^`MAX_LONGS` longs (8 MB), which reaches the tasks as a scalar; a fuller table lets more rows
pass, and loses none. Equal items are one class under their smallest id, so copies in the benchmark do not
multiply hits (`with_members` adds the ids of all members). Hits are reduced to diagonals before texts are looked at
again, and the table of documents that need it is written first, so that the join knows its size.

Defined results: null and empty texts and items have no overlap; an empty table of documents or of items gives none. A null document id is kept; rows that repeat both id and text give one row, rows that repeat only the
id are compared each by its text, and the longest overlap is returned. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, row_key, written

# Fixed masks: five words each.
MASKS = ("111011", "1100001011", "1100010000011")
MIN_WORDS = 13
MIN_IDENTITY = 0.75
PENALTY = 2
BITS_PER_HASH = 256
MIN_LONGS, MAX_LONGS = 10, 20
WEIGHTS = 10_000  # weights along a diagonal are whole numbers: sums must be exact
SUM_BLOCK = 64
ROW_KEY = "__row_key"


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def word_hashes(text: str) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def parts_of(size: int) -> list[int]:
    """The part that each word of a short item belongs to: 2 d parts where d words may differ, or one."""
    parts = max(2 * (size // 4), 1)
    return [i * parts // size for i in range(size)]


def part_hashes(w: Column, size: int) -> list[Column]:
    """A hash for each part of the first `size` words."""
    part = parts_of(size)
    taken = [[F.get(w, F.lit(i)) for i in range(size) if part[i] == k] for k in range(part[-1] + 1)]
    return [F.xxhash64(F.lit(size * MIN_WORDS + k), *words_of) for k, words_of in enumerate(taken)]


def whole_masks(size: int) -> tuple[str, ...]:
    """Masks over a whole item of `size` words, one of which hits wherever a quarter of the words or fewer differ."""
    differ = size // 4
    if not differ:
        return ("1" * size,)
    part = parts_of(size)
    return tuple("".join("01"[part[i] in chosen] for i in range(size)) for chosen in itertools.combinations(range(2 * differ), differ))


def mask_hash(w: Column, mask: str, place: Column) -> Column:
    return F.xxhash64(F.lit(int("1" + mask, 2)), *[F.get(w, place + i) for i, c in enumerate(mask) if c == "1"])


def seed_hashes(hashes: str, masks: tuple[str, ...] = MASKS) -> Column:
    """Window hashes under all masks, place by place: entry p * len(masks) + k is mask k at place p, null
    where the mask does not fit."""
    w = F.col(hashes)

    def at(p: Column) -> Column:
        return F.array(*[F.when(p + len(mask) <= F.size(w), mask_hash(w, mask, p)) for mask in masks])

    last = F.size(w) - min(map(len, masks))
    return F.when(last >= 0, F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), at)))


def exploded_seeds(rows: DataFrame, *keep: str, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """`keep`, place and h for every window of `rows` (hashes: array of word hashes)."""
    out = rows.select(*keep, F.posexplode(seed_hashes("hashes", masks)).alias("n", "h")).where("h IS NOT NULL")
    return out.select(*keep, F.floor(F.col("n") / len(masks)).cast("int").alias("place"), "h")


def item_classes(benchmark: DataFrame) -> DataFrame:
    """item_id of every row and class_id, the smallest id with the same words."""
    keyed = benchmark.select("item_id", F.xxhash64(F.array_join(words("text"), " ")).alias("text_key"))
    return keyed.join(keyed.groupBy("text_key").agg(F.min("item_id").alias("class_id")), "text_key").select("item_id", "class_id")


def distinct_items(benchmark: DataFrame) -> DataFrame:
    """class item_id and hashes, one row for each different sequence of words."""
    rows = benchmark.select("item_id", word_hashes("text").alias("hashes")).where(F.size("hashes") > 0)
    return rows.groupBy("hashes").agg(F.min("item_id").alias("item_id")).select("item_id", "hashes")


def bit_table(hashes: DataFrame) -> tuple[DataFrame, int]:
    """One row `bits`, an array of longs with the bit of every hash set, and the number of its bits."""
    n = hashes.agg(F.approx_count_distinct("h")).first()[0]
    longs = 1 << min(MAX_LONGS, max(MIN_LONGS, math.ceil(math.log2(max(1, n * BITS_PER_HASH / 64)))))
    place = F.pmod("h", F.lit(longs * 64))
    marked = hashes.select(
        F.shiftright(place, 6).alias("i"), F.expr("shiftleft(1L, CAST(pmod(h, 64) AS INT))").alias("bit")
    )
    filled = hashes.sparkSession.range(longs).select(F.col("id").alias("i")).join(marked.groupBy("i").agg(F.bit_or("bit").alias("bit")), "i", "left")
    ordered = F.array_sort(F.collect_list(F.struct("i", F.coalesce("bit", F.lit(0).cast("long")).alias("bit"))))
    return filled.agg(F.transform(ordered, lambda x: x["bit"]).alias("bits")), longs * 64


def bit_test(hashes: DataFrame, name: str) -> Callable[[Column], Column]:
    """1 for a hash whose bit is set: all that occur among `hashes`, and a few others; 0 for any other."""
    table, n = bit_table(hashes)
    table = written(table, name)

    def test(h: Column) -> Column:
        bits = F.get(table.scalar(), F.shiftright(F.pmod(h, F.lit(n)), 6).cast("int"))
        return F.getbit(bits, F.pmod(h, F.lit(64)).cast("int"))

    return test


def passing(windows: DataFrame, hashes: DataFrame) -> DataFrame:
    """Windows whose bit is set: all that occur among `hashes`, and a few others."""
    return windows.where(bit_test(hashes, "benchmark-bits")(F.col("h")) == 1)


def short_windows(rows: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """key, place and h of `rows` (key, hashes) under the masks of items of these sizes, where enough parts are known."""
    known = [items.where(F.size("hashes") == n).select(F.explode(F.array(*part_hashes(F.col("hashes"), n))).alias("h")) for n in sizes]
    seen = bit_test(reduce(DataFrame.unionByName, known), "benchmark-part-bits")
    w = F.col("w")
    at = F.transform(F.sequence(F.lit(0), F.size("hashes") - 1), lambda p: F.slice("hashes", p + 1, MIN_WORDS - 1))
    places = rows.where(F.size("hashes") > 0).select("key", F.posexplode(at).alias("place", "w"))
    enough = {}
    for n in sizes:
        found = reduce(lambda a, b: a + b, [seen(h).cast("int") for h in part_hashes(w, n)])
        enough[n] = (F.size(w) >= n) & (found >= max(n // 4, 1))
    likely = places.where(reduce(lambda a, b: a | b, enough.values()))
    masked = [F.when(enough[n], mask_hash(w, mask, F.lit(0))) for n in sizes for mask in whole_masks(n)]
    return likely.select("key", "place", F.explode(F.array(*masked)).alias("h")).where("h IS NOT NULL")


def best_segment(doc: Column, item: Column, diagonal: Column) -> Column:
    """struct(score, start, n, equal): the best segment of the diagonal; start is a place in the document."""
    start = F.greatest(diagonal, F.lit(0))
    length = F.least(F.size(doc), F.size(item) + diagonal) - start
    same = F.zip_with(F.slice(doc, start + 1, length), F.slice(item, start - diagonal + 1, length), lambda a, b: a == b)
    zero = F.lit(0)
    empty = F.struct(*[zero.alias(n) for n in ("at", "cur", "cur_from", "cur_equal", "score", "from", "n", "equal")])

    def step(acc: Column, equal: Column) -> Column:
        one = F.when(equal, 1).otherwise(-PENALTY)
        fresh = acc["cur"] <= 0
        cur = F.when(fresh, one).otherwise(acc["cur"] + one)
        begin = F.when(fresh, acc["at"]).otherwise(acc["cur_from"])
        hits = F.when(fresh, 0).otherwise(acc["cur_equal"]) + F.when(equal, 1).otherwise(0)
        better = cur > acc["score"]
        return F.struct(
            (acc["at"] + 1).alias("at"), cur.alias("cur"), begin.alias("cur_from"), hits.alias("cur_equal"),
            F.when(better, cur).otherwise(acc["score"]).alias("score"),
            F.when(better, begin).otherwise(acc["from"]).alias("from"),
            F.when(better, acc["at"] + 1 - begin).otherwise(acc["n"]).alias("n"),
            F.when(better, hits).otherwise(acc["equal"]).alias("equal"),
        )

    return F.aggregate(
        same, empty, step, lambda a: F.struct(a["score"].alias("score"), (a["from"] + start).alias("start"), a["n"].alias("n"), a["equal"].alias("equal"))
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running_sums(values: Column) -> Column:
    """0 and the sums of the first 1, 2, ... values; appended in blocks, so that long arrays are not copied for each value."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / SUM_BLOCK)), lambda b: F.slice(values, (b * SUM_BLOCK + 1).cast("int"), SUM_BLOCK))

    def append(sums: Column, x: Column) -> Column:
        return F.concat(sums, F.array(F.element_at(sums, -1) + x))

    def extend(sums: Column, block: Column) -> Column:
        own = F.aggregate(block, F.array(F.element_at(sums, -1)), append)
        return F.concat(sums, F.slice(own, 2, SUM_BLOCK))

    return F.aggregate(blocks, F.array(F.lit(0).cast("long")), extend)


def longest_segment(doc: Column, item: Column, diagonal: Column, min_identity: float = MIN_IDENTITY) -> Column:
    """struct(start, n, equal): the longest segment of the diagonal with at least `min_identity` equal words, the one
    with more equal words, then the first, among equally long ones; start is a place in the document.

    An equal word weighs 1 - `min_identity`, a different one -`min_identity`: a segment is good if its sum is not
    negative. In the order of the running sums, each end takes the first place met so far as its start.
    """
    start = F.greatest(diagonal, F.lit(0))
    length = F.least(F.size(doc), F.size(item) + diagonal) - start
    loss = round(min_identity * WEIGHTS)
    weigh = lambda a, b: F.when(a == b, F.lit(WEIGHTS - loss)).otherwise(F.lit(-loss)).cast("long")
    weights = F.zip_with(F.slice(doc, start + 1, length), F.slice(item, start - diagonal + 1, length), weigh)
    by_sum = F.sort_array(F.transform(_let(weights, _running_sums), lambda x, i: F.struct(x.alias("sum"), i.alias("at"))))
    none = F.struct(*[F.lit(0).cast(t).alias(n) for n, t in (("n", "int"), ("equal", "int"), ("early", "int"))])
    empty = F.struct(F.lit(2**31 - 1).alias("from"), F.lit(0).cast("long").alias("low"), none.alias("best"))

    def step(acc: Column, x: Column) -> Column:
        sooner = x["at"] < acc["from"]
        begin, low = F.when(sooner, x["at"]).otherwise(acc["from"]), F.when(sooner, x["sum"]).otherwise(acc["low"])
        n = x["at"] - begin
        equal = F.round((x["sum"] - low + n * loss) / WEIGHTS).cast("int")
        best = F.greatest(acc["best"], F.struct(n.alias("n"), equal.alias("equal"), (-begin).alias("early")))
        return F.struct(begin.alias("from"), low.alias("low"), best.alias("best"))

    return F.aggregate(by_sum, empty, step, lambda a: F.struct(
        (start - a["best"]["early"]).alias("start"), a["best"]["n"].alias("n"), a["best"]["equal"].alias("equal")
    ))


def segments(
    docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, min_identity: float = MIN_IDENTITY, trimmed: bool = False
) -> DataFrame:
    """key (hash of id and text), doc_id, item_id, diagonal and s (the segment) for every diagonal with an overlap."""
    items = written(distinct_items(benchmark), "benchmark-items")
    size = F.size("hashes")
    key = row_key().alias("key")
    rows = docs.select(key, word_hashes("text").alias("hashes"))
    windows = exploded_seeds(rows, "key")
    if trimmed:
        found = exploded_seeds(items, "item_id")
    else:
        found = exploded_seeds(items.where(size >= MIN_WORDS), "item_id")
        # At most MIN_WORDS - 1 rows.
        short = [n for (n,) in sorted(items.where(size < MIN_WORDS).select(size).distinct().collect())]
        for n in short:
            found = found.unionByName(exploded_seeds(items.where(size == n), "item_id", masks=whole_masks(n)))
        if short:
            windows = windows.unionByName(short_windows(rows, items, short))
    seeds = written(found.withColumnRenamed("place", "item_place"), "benchmark-seeds")
    hits = passing(windows, seeds.select("h")).join(seeds, "h")
    diagonals = written(hits.select("key", "item_id", (F.col("place") - F.col("item_place")).alias("diagonal")).distinct(), "diagonals")
    touched = written(diagonals.select("key").distinct(), "touched")
    texts = docs.select(key, "doc_id", "text").join(touched, "key", "left_semi").dropDuplicates(["key"])
    texts = written(texts.select("key", "doc_id", word_hashes("text").alias("hashes")), "touched-texts")
    both = diagonals.join(texts, "key").join(items.withColumnRenamed("hashes", "item_hashes"), "item_id")
    along = F.col("hashes"), F.col("item_hashes"), F.col("diagonal")
    found = both.select(
        "key", "doc_id", "item_id", "diagonal", F.size("item_hashes").alias("size"),
        (best_segment(*along) if trimmed else longest_segment(*along, min_identity)).alias("s"),
    )
    enough = (F.col("s.n") >= F.least(F.lit(min_words), F.col("size"))) & (F.col("s.equal") >= min_identity * F.col("s.n"))
    return found.where(enough).drop("size")


def overlaps(
    docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, min_identity: float = MIN_IDENTITY, trimmed: bool = False
) -> DataFrame:
    """doc_id, item_id, n_words, n_equal, doc_start, item_start: the best overlap of each document with each
    class of items it overlaps. Places count words from 0. All overlaps are found only without `trimmed`."""
    good = segments(docs, benchmark, min_words, min_identity, trimmed)
    rank = F.struct("s.equal", "s.n", (-F.col("s.start")).alias("early"), "diagonal")
    best = good.groupBy("doc_id", "item_id").agg(F.max(rank).alias("b"))
    return best.select(
        "doc_id", "item_id", F.col("b.n").alias("n_words"), F.col("b.equal").alias("n_equal"),
        (-F.col("b.early")).alias("doc_start"), (-F.col("b.early") - F.col("b.diagonal")).alias("item_start"),
    )


def with_members(found: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`found` with item_ids, the ids of all items of the class that item_id names, in order."""
    members = item_classes(benchmark).groupBy("class_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    return found.join(members.withColumnRenamed("class_id", "item_id"), "item_id", "left").select(*found.columns, "item_ids")


def without_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all columns, whose text overlaps no item."""
    name = free_name(docs, ROW_KEY)
    hit = written(segments(docs, benchmark).select(F.col("key").alias(name)).distinct(), "overlapping")
    return docs.withColumn(name, row_key()).join(hit, name, "left_anti").drop(name)
