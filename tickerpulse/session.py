"""Session defaults, shared scratch space and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A shuffle partition of this size sorts and aggregates in memory on an ordinary executor core.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partitions to start a shuffle of this size with; AQE merges those that turn out small."""
    return max(200, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(app: str = "tickerpulse", master: str | None = None,
                  shuffled_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on.

    ``shuffled_bytes`` is the largest shuffle to be expected (the flagship: some 150 bytes per
    post). AQE only splits partitions of joins and writes, so aggregates need enough from the start.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # state of long-running streams lives outside the JVM heap and is checkpointed by its changes
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if shuffled_bytes is not None:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                 str(shuffle_partitions(shuffled_bytes)))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickerpulse-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def ship_package(spark: SparkSession) -> None:
    """Python workers find this package where the driver runs it from, if it is not installed."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage once so later branches do not recompute it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
