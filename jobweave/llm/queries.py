"""One query per corpus operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import backoff, collocations, decontaminate, exhaustive, langid, licenses, maintext, perplexity, quality, reversedsearch, segment, simhash, warc
from .common import crc_mod, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(tune(spark), folder)

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return run


@query
def op2_warc_chunks(spark, folder):
    """Every page through a WARC archive and back."""
    records = warc.round_trip(spark, read(spark, folder, "pages"))
    return records.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_simhash(spark, folder):
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query
def op10_language(spark, folder):
    """Language of every document, learned from four fifths of those that name theirs."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    net = langid.train(langid.training_rows(docs, crc_mod("doc_id", 5) != 0))
    found = langid.with_language(docs.select("doc_id", "text"), net)
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_share")


@query
def op8_decontaminate(spark, folder):
    """Overlaps of documents with benchmark items, each with the ids of all equal items."""
    items = read(spark, folder, "benchmark")
    return decontaminate.with_members(decontaminate.overlaps(read(spark, folder, "documents"), items, trimmed=False), items)


@query
def op9_quality(spark, folder):
    """Quality of every document, learned from the labels of two thirds of the ids."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    voters = quality.learn(docs, read(spark, folder, "labels"), crc_mod("doc_id", 3) != 1)
    score = F.col("quality_score")
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return quality.with_quality(docs, voters).select(
        "doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


@query
def op5_main_text(spark, folder):
    """Article text of every page."""
    found = maintext.with_main_text(read(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op3_perplexity(spark, folder):
    """Base counts and perplexity verdict of every document."""
    return perplexity.judged(read(spark, folder, "documents")).drop("lang")


@query
def op4_licenses(spark, folder):
    """Licence paragraphs of all documents."""
    return licenses.scan(read(spark, folder, "documents"))


@query
def op6_backoff(spark, folder):
    """Stupid-backoff score of every document under the counts of all."""
    return backoff.scored(read(spark, folder, "documents"))


@query
def op1_sampled_pieces(spark, folder):
    """Sampled segmentations of every document, and whether they decode to its text."""
    return segment.encode(read(spark, folder, "documents"), decoded=True)


@query
def op11_exact_topk(spark, folder):
    """The five rows with the largest integer inner product for every vector whose id is divisible by 50."""
    return exhaustive.search(read(spark, folder, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0)


@query
def op12_collocations(spark, folder):
    """The 2000 strongest phrases of every language."""
    return collocations.collocations(read(spark, folder, "documents"))


@query
def op13_reversed_search(spark, folder):
    """The ten highest-scoring documents for every benchmark item."""
    return reversedsearch.ranked(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
