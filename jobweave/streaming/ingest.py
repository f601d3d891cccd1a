"""Incremental ingest: only postings that were never seen before enter the store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.ranking import first_per_group
from ..operators.store import POSTING_KEY
from ..session import materialize

BUCKETS = 256


def bucket_of(buckets: int) -> Column:
    """The part of the memory that knows a posting key."""
    return F.pmod(F.xxhash64(*POSTING_KEY), F.lit(buckets)).cast("int")


def _bucket_folders(spark: SparkSession, store: str, column: str) -> set[int]:
    """The buckets that hold anything. A store of another layout is refused, as its keys would not be found."""
    root = spark._jvm.org.apache.hadoop.fs.Path(store)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return set()
    names = [s.getPath().getName() for s in files.listStatus(root)]
    names = [n for n in names if not n.startswith(("_", "."))]
    if odd := [n for n in names if not n.startswith(f"{column}=")]:
        raise ValueError(f"{store} is not a store of {column}: it holds {sorted(odd)[0]}")
    return {int(n.split("=")[1]) for n in names}


def stored_keys(spark: SparkSession, store: str, schema: StructType, batch_id: int, hit: Sequence[int], buckets: int = BUCKETS) -> DataFrame:
    """Keys that earlier batches have stored in the buckets `hit`. Folders of other buckets are neither listed nor read."""
    column = bucket_column(buckets)
    there = sorted(_bucket_folders(spark, store, column) & set(hit))
    if not there:
        return spark.createDataFrame([], schema).select(*POSTING_KEY)
    fields = StructType([*schema.fields, StructField(column, IntegerType()), StructField("batch", LongType())])
    paths = [f"{store}/{column}={b}" for b in there]
    stored = spark.read.schema(fields).option("basePath", store).parquet(*paths)
    return stored.filter(F.col("batch") < batch_id).select(*POSTING_KEY)


def bucket_column(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def ingest_stream(records: DataFrame, store: str, checkpoint: str, order: Sequence[Column], buckets: int = BUCKETS) -> StreamingQuery:
    """Append the first record of every unseen posting key to `store`, then stop at the end of the input.

    The store is the memory: a key seen long ago is still known. It is kept in buckets by a hash of the key, and a
    micro-batch opens only the buckets its keys belong to, reading no column but the keys. A batch writes folders of
    its own within the buckets and looks only at earlier batches, so a batch that is run again after a failure
    replaces its files and gives the same rows. `buckets` must stay what it was when the store began.
    """
    schema = records.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        column = bucket_column(buckets)
        # Written once: its buckets are asked for first, then its rows.
        firsts = materialize(first_per_group(batch, POSTING_KEY, order).withColumn(column, bucket_of(buckets)), "micro-batch")
        hit = [r[0] for r in firsts.select(column).distinct().collect()]  # at most `buckets` rows
        known = stored_keys(spark, store, schema, batch_id, hit, buckets)
        fresh = firsts.join(known, list(POSTING_KEY), "left_anti").withColumn("batch", F.lit(batch_id).cast("long"))
        # One task for a bucket, so that a bucket gets one file a batch.
        rows = fresh.repartition(column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        rows.partitionBy(column, "batch").parquet(store)

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def deduplicated(records: DataFrame, time: str, within: str) -> DataFrame:
    """Bounded-memory variant: drops repeats of a key that arrive within `within` of each other."""
    return records.withWatermark(time, within).dropDuplicatesWithinWatermark(list(POSTING_KEY))
