"""Session builder with the settings the plans are designed around."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime re-planning does the physical tuning: small shuffle partitions are
# merged, oversized join partitions are split, and a rebalance before a write
# cuts a hot table partition into several files.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # About the size of a written file before encoding.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.filterPushdown": "true",
}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def build_session(app_name: str = "shopgrain", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def stored_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of the files below some paths."""
    context = spark.sparkContext
    total = 0
    for path in paths:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        if files.exists(folder):
            total += files.getContentSummary(folder).getLength()
    return total


@contextmanager
def fitted_shuffles(
    spark: SparkSession,
    paths: Iterable[str],
    bytes_per_partition: int = 16 * 1024**2,
    merged_bytes: int = 32 * 1024**2,
) -> Iterator[int]:
    """Enough shuffle partitions for the files below ``paths``, for the jobs inside.

    Adaptive execution merges partitions that turn out small but cannot cut a
    shuffle finer than it was planned, so the number follows the bytes that are
    read, without a limit, and is never lowered. Partitions are merged up to
    ``merged_bytes`` at most: rows take several times as much when a task sorts
    them. Shuffle files go when the job that made them ends, not when the driver happens
    to collect its garbage. A task writes a few folders at a time without sorting its rows
    for it. Later work finds the session as it was.
    """
    number, merged = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {key: spark.conf.get(key) for key in (number, merged, _CLEANUP, _WRITERS)}
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    wanted = max(int(before[number]), -(-stored_bytes(spark, paths) // bytes_per_partition))
    spark.conf.set(number, str(wanted))
    spark.conf.set(merged, str(min(merged_bytes, bytes_of(before[merged]))))
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_WRITERS, str(max(16, int(before[_WRITERS]))))
    try:
        yield wanted
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def joins_as_dealt(spark: SparkSession) -> Iterator[None]:
    """Joins take two sides that were dealt out alike by some of the joined columns as they
    are, for the jobs inside; else Spark moves both again by all of them."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_scans(spark: SparkSession, most_bytes: int = 32 * 1024**2) -> Iterator[None]:
    """Tasks that read at most ``most_bytes`` of files, for the jobs inside that sort what
    they read before a shuffle or without one."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(name, str(min(most_bytes, bytes_of(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)
