"""Session settings and the shared folder for materialised intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every plan in this package relies on. Shuffle partition counts and broadcast
# thresholds are left to the cluster: AQE coalesces small partitions and picks broadcasts from the
# measured size of a side.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Top-k and first-row windows cut every group before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Rows for few folders are written as they come, without a sort by folder; beyond eight folders a task sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Rows that go to Python carry whole pages and texts: their batches are bounded by bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once for each application, so that they can import it
    from any working directory and on any machine."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="jobweave-"), "jobweave.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        packed.write(path, os.path.relpath(path, os.path.dirname(root)))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return ship(spark)


def build_session(app: str = "jobweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="jobweave-")
        return _local_folders[app]
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, under the application's id, so that the folders of
    finished applications can be expired."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/jobweave/{app}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Call it when no DataFrame reads them any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{shared_folder(spark)}/jobweave/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, so that lost executors cost no recomputation
    and later plans see exactly one version of any partition-dependent value."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
