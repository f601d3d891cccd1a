"""What several operators share: table access, hashing rules and bounded slices of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize, tune

# White space that separates words everywhere in this package: blank and the control characters 9 to 13.
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def crc_mod(name: str, n: int) -> Column:
    """crc32 of a column as text, modulo `n`; null stays null."""
    return F.crc32(F.col(name).cast("string")) % n


def row_key() -> Column:
    """A hash of a document's id and text: what tells rows apart where ids repeat."""
    return F.xxhash64("doc_id", "text")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores behind it until no column of `df` is called so, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without columns that are called so, whatever the case: what an operator adds replaces them, as withColumn does."""
    taken = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in taken]
    return df.drop(*clash) if clash else df


def extended(df: DataFrame, *columns: tuple[str, str]) -> StructType:
    """The schema of `df` with further (name, type) columns behind its own."""
    schema = StructType(list(df.schema.fields))
    for name, kind in columns:
        schema = schema.add(name, kind)
    return schema


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` from the shared folder: what follows neither repeats its work nor loses it with an executor."""
    return materialize(df, name)


def slices(lengths: np.ndarray, budget: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose lengths add up to at most `budget`, or single rows beyond it."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > budget:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind one another, and the offsets of each; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
