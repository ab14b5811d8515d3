"""Session settings the jobs are designed for, and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Joins rely on Spark's own size checks: a side is broadcast only when its
# statistics (or, under AQE, its measured shuffle output) are below the
# threshold, and is shuffled otherwise. A hot join key is split by AQE, even
# where that costs one more shuffle. The wide projections compile to methods the
# JVM would only interpret when fused into one; past its limit of 8000 bytes
# Spark compiles them in parts instead.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_SCRATCH: set[str] = set()

SHUFFLE_TARGET_BYTES = 128 * 1024 * 1024


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply SETTINGS where the cluster did not choose otherwise.

    ``input_bytes`` is the volume the job will shuffle; it sets how many
    partitions a shuffle starts with (AQE merges the small ones afterwards).
    """
    chosen = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    if input_bytes is not None:
        parts = max(spark.sparkContext.defaultParallelism, math.ceil(input_bytes / SHUFFLE_TARGET_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete their shuffle files when they end, not when the driver happens to collect garbage.

    For writes to files that later steps start from: nothing reads these shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def size_of(df: DataFrame) -> int:
    """Spark's estimate of a frame's bytes; for stored tables that of their files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder the cluster names, for tables one application needs.

    Every executor must see it, so a machine-local folder is used only in
    local mode, where driver and executors are one process. The application's folders go when it ends.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="orderloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    mine = f"{root.rstrip('/')}/orderloom-{spark.sparkContext.applicationId}"
    if mine not in _SCRATCH:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(mine)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _SCRATCH.add(mine)
    return f"{mine}/{purpose}-{uuid.uuid4().hex}"
