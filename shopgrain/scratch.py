"""Scratch tables in the folder the cluster shares between its nodes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_used_by: set[str] = set()


def _root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    # Nothing configured and one machine, as in the unit tests.
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="shopgrain-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def _app_folder(spark: SparkSession) -> str:
    return f"{_root(spark).rstrip('/')}/shopgrain-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below this application's scratch folder.

    The folder goes away with the Python process, or earlier by ``release``.
    """
    if _app_folder(spark) not in _used_by:
        _used_by.add(_app_folder(spark))
        atexit.register(_release_quietly, spark)
    return f"{_app_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the files.

    Cuts the lineage, survives lost executors, and gives later joins exact
    table sizes to choose their strategy from.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The same for a table that is not needed after the block: it is deleted."""
    path = new_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)


def exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, if there is one."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def _release_quietly(spark: SparkSession) -> None:
    try:
        release(spark)
    except Exception:  # noqa: BLE001 - the session may have been stopped before
        pass


def release(spark: SparkSession) -> None:
    """Delete everything this application wrote to its scratch folder."""
    delete(spark, _app_folder(spark))
