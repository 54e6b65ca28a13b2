"""Tables that are replaced in one step.

A new version of a table is written to a folder of its own and the catalog table is then
pointed to it, so a reader sees all of the old rows or all of the new, never a mixture
and never an empty folder. A run that breaks before the switch leaves the table as it
was. Versions that the table left are deleted by the next but one publication, when
readers that began with them are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import scratch
from .writers import write_table


def _versions(spark: SparkSession, root: str) -> list[int]:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    return sorted(int(n[2:]) for n in names if n.startswith("v-") and n[2:].isdigit())


def write_version(df: DataFrame, root: str) -> str:
    """Write the rows as the next version below ``root``; its path. Nothing reads it yet."""
    following = max(_versions(df.sparkSession, root), default=0) + 1
    path = f"{root}/v-{following}"
    write_table(df, path)
    return path


def switch_table(spark: SparkSession, name: str, path: str) -> None:
    """Point a catalog table to a version, or create it over the first one."""
    if spark.catalog.tableExists(name):
        spark.sql(f"alter table {name} set location '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet")


def publish_table(df: DataFrame, name: str, root: str, keep: int = 2) -> str:
    """Replace a catalog table's rows, of the same columns, by those of the frame, which
    may read the table itself; the path of the new version. ``keep`` versions stay."""
    spark = df.sparkSession
    path = write_version(df, root)
    switch_table(spark, name, path)
    for version in _versions(spark, root)[:-keep]:
        scratch.delete(spark, f"{root}/v-{version}")
    return path
