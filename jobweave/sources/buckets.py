"""Stored tables that change: rows in buckets by a hash of their key, of which a change rewrites only those it meets.

    <path>/rows/bucket=<b>/version=<v>/     the rows of a bucket as version v left them
    <path>/commits/run=<v>/                 the buckets that version v has written, and how many rows each has

A bucket's rows are those of the last committed version that wrote it. A version writes new folders beside the ones
being read and is committed last, by one small write; a change that fails before leaves the table as it was, and is
simply repeated under the same number. Files of buckets that a change does not meet are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators import store
from ..operators.ranking import first_per_group
from ..session import materialize
from .tables import complete_runs

BUCKETS = 256
COMMIT = StructType([StructField("bucket", IntegerType()), StructField("n", LongType()), StructField("buckets", IntegerType())])


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.buckets = list(key), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        return complete_runs(self.spark, f"{self.path}/commits")

    def current(self, before: int | None = None) -> dict[int, int]:
        """The version that holds each bucket's rows, of all versions or those below `before`; empty buckets are absent."""
        numbers = [v for v in self.versions() if before is None or v < before]
        if not numbers:
            return {}
        commits = self.spark.read.schema(COMMIT).option("basePath", f"{self.path}/commits").parquet(*[f"{self.path}/commits/run={v}" for v in numbers])
        # At most a row for each bucket.
        last = commits.groupBy("bucket").agg(F.max_by(F.struct("run", "n", "buckets"), "run").alias("c")).select("bucket", "c.*").collect()
        if odd := {r["buckets"] for r in last} - {self.buckets}:
            raise ValueError(f"{self.path} has {sorted(odd)[0]} buckets, not {self.buckets}")
        return {r["bucket"]: r["run"] for r in last if r["n"]}

    def read(self, only: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """All rows, or those of some buckets; folders of other buckets are not listed."""
        wanted = self.current(before)
        paths = [f"{self.path}/rows/bucket={b}/version={v}" for b, v in sorted(wanted.items()) if only is None or b in set(only)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema).filter(F.lit(False))

    def change(self, version: int, batch: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], laid_out: bool = False) -> list[int]:
        """Write what `apply` makes of the rows of the buckets that the keys of `batch` belong to; returns these buckets.

        `apply` gets those rows and the batch, each with the column `bucket` and laid out by it, and keeps rows in their
        buckets. What it joins by bucket and key is not shuffled again; with `laid_out` it shuffles nothing itself and
        returns `bucket`, so that its rows are written where they are. Rows without a key (a null in it) have a bucket
        as well. A version that is repeated replaces what it has written.
        """
        batch = materialize(batch, "batch")
        met = sorted(r[0] for r in batch.select(self.bucket()).distinct().collect())  # at most `buckets` rows
        stored, new = (df.withColumn("bucket", self.bucket()).repartition("bucket") for df in (self.read(met, before=version), batch))
        rows = apply(stored, new)
        if not laid_out:
            rows = rows.withColumn("bucket", self.bucket()).repartition("bucket")
        placed = rows.select(*self.schema.fieldNames(), "bucket").withColumn("version", F.lit(version).cast("long"))
        # Buckets are of equal size, as a hash deals their keys; a task writes the rows of whole buckets or a part of one.
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "version").parquet(f"{self.path}/rows")
        written = [f"{self.path}/rows/bucket={b}/version={version}" for b in met]
        sizes = self._sizes(written)
        commit = self.spark.createDataFrame([(b, sizes.get(b, 0), self.buckets) for b in met], COMMIT)
        commit.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/commits/run={version}")
        return met

    def _sizes(self, paths: list[str]) -> dict[int, int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path
        files = folder(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        there = [p for p in paths if files.exists(folder(p))]
        if not there:
            return {}
        fields = StructType([*self.schema.fields, StructField("bucket", IntegerType()), StructField("version", LongType())])
        rows = self.spark.read.schema(fields).option("basePath", f"{self.path}/rows").parquet(*there)
        return {r["bucket"]: r["count"] for r in rows.groupBy("bucket").count().collect()}

    def upsert(self, version: int, batch: DataFrame, order: Sequence[Column]) -> list[int]:
        """The first row per key of `batch` in `order` replaces the stored row as a whole."""
        # Repeats are cut before the batch is written, so that what is shuffled behind it has one row per key.
        firsts = first_per_group(batch, self.key, order).select(*self.schema.fieldNames())

        def apply(rows: DataFrame, new: DataFrame) -> DataFrame:
            kept = rows.join(new.select(*self._placed_key()), self._placed_key(), "left_anti")
            return kept.unionByName(new)

        return self.change(version, firsts, apply, laid_out=True)

    def insert_if_absent(self, version: int, batch: DataFrame, order: Sequence[Column]) -> list[int]:
        """Add the first row per key of `batch` in `order` where the key is not stored yet."""
        firsts = first_per_group(batch, self.key, order).select(*self.schema.fieldNames())
        return self.change(version, firsts, lambda rows, new: rows.unionByName(new.join(rows.select(*self._placed_key()), self._placed_key(), "left_anti").select(*rows.columns)), laid_out=True)

    def mark_sent(self, version: int, sent: DataFrame) -> list[int]:
        """Set `email_sent` for the keys of `sent`."""
        return self.change(version, sent, lambda rows, keys: store.mark_sent(rows, keys, self._placed_key()), laid_out=True)

    def _placed_key(self) -> list[str]:
        return ["bucket", *self.key]

    def vacuum(self) -> int:
        """Delete the folders of versions that no bucket reads any more; returns how many. Only for when no reader of
        an older version and no writer is left."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path
        root = folder(f"{self.path}/rows")
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        wanted, gone = {f"bucket={b}/version={v}" for b, v in self.current().items()}, 0
        for bucket in files.listStatus(root) if files.exists(root) else []:
            if bucket.isDirectory() and bucket.getPath().getName().startswith("bucket="):
                for version in files.listStatus(bucket.getPath()):
                    if f"{bucket.getPath().getName()}/{version.getPath().getName()}" not in wanted:
                        gone += files.delete(version.getPath(), True)
        return gone
