"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

    language    documents without a language go
    quality     documents of low quality go
    duplicates  one document of each group of near-duplicates stays
    benchmark   documents that overlap a benchmark item go
    pieces      sampled SentencePiece segmentations of what is left

Every stage but the last returns the columns of `documents`, whatever they are; a stage learns and counts on
the documents it is given. An empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobweave.llm import decontaminate, langid, quality, segment, simhash
from jobweave.llm.common import crc_mod, read
from jobweave.session import materialize, tune

# A text may mix languages; one that fits none has a probability near that of chance.
LEAST_LANGUAGE = 0.4
LEAST_QUALITY = 0.5

# No SQL: the language and quality stages are trained models.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = langid.train(langid.training_rows(docs, crc_mod("doc_id", 5) != 0))
    return langid.with_language(docs, net, keep=LEAST_LANGUAGE)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    voters = quality.learn(docs, read(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return quality.with_quality(docs, voters, keep=LEAST_QUALITY)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_overlaps(docs, read(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return segment.encode(docs)


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("duplicates", duplicates),
    ("benchmark", benchmark),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
