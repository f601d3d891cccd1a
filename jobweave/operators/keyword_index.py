"""Keyword search through an index, for boards with very many keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .store import POSTING_KEY

GRAM = 4
BITS = 1 << 22


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def gram_hashes(text: Column, n: int) -> Column:
    """Hashes of the distinct runs of `n` characters of a text, with 0 characters that of the empty run."""
    if n == 0:
        return F.array(F.xxhash64(F.lit("")))

    def runs(chars: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(chars) - n + 1)
        found = F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(chars, i, n), "")))
        return F.when(F.size(chars) >= n, F.array_distinct(found)).otherwise(F.array().cast("array<long>"))

    return _let(F.filter(F.split(text, ""), lambda c: c != ""), runs)


def keyword_index(sources: DataFrame) -> DataFrame:
    """source_id, keyword, word (folded), size and gram: for each keyword the run of `GRAM` characters, or the whole of a
    shorter word, that fewest keywords of the board have."""
    words = sources.select("source_id", F.explode(F.array_distinct("search_keywords")).alias("keyword")).where("keyword IS NOT NULL").distinct()
    words = words.withColumn("word", F.lower("keyword")).withColumn("size", F.least(F.length("word"), F.lit(GRAM)))
    by_size = [F.when(F.col("size") == n, gram_hashes(F.col("word"), n)) for n in range(GRAM + 1)]
    grams = materialize(words.withColumn("gram", F.explode(F.coalesce(*by_size))), "keyword-grams")
    shared = grams.groupBy("source_id", "size", "gram").agg(F.count(F.lit(1)).alias("_n"))
    # A keyword has as many rows as runs.
    order = Window.partitionBy("source_id", "keyword").orderBy("_n", "gram")
    ranked = grams.join(shared, ["source_id", "size", "gram"]).withColumn("_rank", F.row_number().over(order))
    return materialize(ranked.where("_rank = 1").drop("_rank", "_n"), "keyword-index")


def _bit_row(index: DataFrame) -> DataFrame:
    """One row `bits`: an array of `BITS` bits in longs, with the bit of every indexed run set."""
    bit = F.expr("shiftleft(1L, CAST(pmod(gram, 64) AS INT))")
    place = F.shiftright(F.pmod("gram", F.lit(BITS)), 6)
    marked = index.select(place.alias("i"), bit.alias("bit")).groupBy("i").agg(F.bit_or("bit").alias("bit"))
    longs = index.sparkSession.range(BITS // 64).select(F.col("id").alias("i")).join(marked, "i", "left")
    ordered = F.array_sort(F.collect_list(F.struct("i", F.coalesce("bit", F.lit(0).cast("long")).alias("bit"))))
    return materialize(longs.agg(F.transform(ordered, lambda x: x["bit"]).alias("bits")), "keyword-bits")


def indexed_keyword_hits(postings: DataFrame, sources: DataFrame) -> DataFrame:
    """Postings (with distinct keys) that contain a search keyword of their board, with the matching keywords sorted.

    The same rows as `tags.keyword_hits`, for any number of keywords: a keyword stands in a text only if one of its
    runs of characters does, so texts and keywords are joined on one run for each keyword and compared where it
    meets. A bit table of fixed size drops the runs of a text that no keyword has where the text is read, so that
    neither a row for each keyword nor one for each character is made. Runs that meet are joined by board, size
    and hash; a hash that meets by chance costs a comparison.
    """
    key = list(POSTING_KEY)
    index = keyword_index(sources)
    bits = _bit_row(index)
    sizes = [r[0] for r in index.select("size").distinct().collect()]  # at most GRAM + 1 rows
    if not sizes:
        return postings.select(*key, F.array().cast("array<string>").alias("keywords")).limit(0)
    boards = index.select("source_id").distinct()
    texts = postings.select(*key, F.lower(F.concat_ws(" ", "title", "description_raw")).alias("text"))
    texts = materialize(texts.join(boards, "source_id", "left_semi"), "texts")

    def sized(n: int) -> Column:
        return F.transform(gram_hashes(F.col("text"), n), lambda g: F.struct(F.lit(n).alias("size"), g.alias("gram")))

    runs = F.flatten(F.array(*[sized(n) for n in sorted(sizes)]))
    found = texts.select(*key, F.explode(runs).alias("run")).select(*key, "run.size", "run.gram")
    word = F.get(bits.scalar(), F.shiftright(F.pmod("gram", F.lit(BITS)), 6).cast("int"))
    found = found.where(F.getbit(word, F.pmod("gram", F.lit(64)).cast("int")) == 1)
    pairs = found.join(index, ["source_id", "size", "gram"]).select(*key, "keyword", "word")
    hits = pairs.join(texts, key).where(F.col("text").contains(F.col("word")))
    return hits.groupBy(*key).agg(F.array_sort(F.collect_set("keyword")).alias("keywords"))
