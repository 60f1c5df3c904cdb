"""Session settings and shared storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # keeps the event-id state of the streaming dedup on local disk instead of the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "perkline", master: str | None = None, **overrides: str) -> SparkSession:
    """Session with the settings the library is tuned for; ``overrides`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master without the setting falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="perkline-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, honouring the session's own setting."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the application's own part of the shared folder."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def application_folder(spark: SparkSession) -> str:
    """Where this application keeps what it stores on the way; dead once the application has ended."""
    return f"{shared_root(spark)}/perkline/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove all that this application has stored on the way; results not yet written are lost with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and continue from the stored copy.

    Later steps then neither recompute it nor depend on the executors that produced it, and the
    optimizer sees its true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
