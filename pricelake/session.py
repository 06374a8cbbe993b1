"""Session defaults and the durable scratch location used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "pricelake") -> SparkSession:
    """Single-machine session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the session's setting, or a temp folder in local mode only."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        if not configured:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            configured = tempfile.mkdtemp(prefix="pricelake-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and freezes non-deterministic columns."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: A lookup table of up to so many rows is sent to every executor.
LOOKUP_ROWS = 100_000


def lookup(side: DataFrame) -> DataFrame:
    """The lookup side of a join, computed once and counted: broadcast while it is small, shuffled beyond.

    Left to itself AQE shuffles facts by a key of few values (its rule of empty partitions), which gives as many
    tasks as there are values.
    """
    kept = checkpointed(side)
    return F.broadcast(kept) if kept.count() <= LOOKUP_ROWS else kept


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_copy(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows written once to the shared folder as compressed columns, for as long as the block lasts.

    Cuts the lineage like a checkpoint, takes a fraction of its disk and lets later scans read single columns.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


FREED_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside the block each query deletes its shuffle files when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(FREED_SHUFFLES, None)
    spark.conf.set(FREED_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED_SHUFFLES)
        else:
            spark.conf.set(FREED_SHUFFLES, before)


def spread(df: DataFrame) -> DataFrame:
    """Spread few large input splits over the free cores before expensive per-row work.

    Input that already has a split per core is left alone, so large scans are never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
