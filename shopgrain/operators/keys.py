"""Surrogate keys that cannot collide: numbers, kept from load to load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import scratch

# Bits of a row's place in its partition in monotonically_increasing_id.
_PLACE = 33


def numbered(keys: DataFrame, first: int = 1) -> DataFrame:
    """Rows of different keys with a long ``number``: their places in the order of all
    their columns, from ``first`` on without gaps, however they are distributed.

    Keys are sorted by ranges and stored; the number of keys in each partition, summed
    up over the partitions before it, is added to a row's place in its own.
    """
    order = keys.columns
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = scratch.materialize(ranged.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("_id", _PLACE)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row for each partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE) - 1))
    joined = placed.withColumn("_part", part).join(offsets, "_part")
    return joined.select(*order, (place + F.col("_before") + first).alias("number"))


def assign_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The numbers of these keys, after giving new ones to those that have none.

    The table of keys below ``path`` has a folder for each load. A load numbers the keys
    that the table does not have, from the highest number on, in their order, and writes
    them to the next folder; so numbers are unique by construction and stay the same for
    ever. A load that is repeated finds its keys there; one that broke has written nothing
    that counts, and its folder is replaced. Loads of one table run one at a time. Null keys
    are keys like any other.
    """
    wanted = keys.distinct()
    condition = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in keys.columns]
    loads = _loads(spark, path)
    schema = type(keys.schema)([*keys.schema]).add("number", "long")

    def known() -> DataFrame:
        paths = [f"{path}/load-{k:09d}" for k in loads]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    highest = known().agg(F.max("number")).first()[0] or 0
    new = wanted.alias("w").join(known().alias("k"), condition("w", "k"), "left_anti").select("w.*")
    with scratch.materialized(new, "new-keys") as new:
        if not new.isEmpty():
            following = max(loads, default=0) + 1
            numbered(new, highest + 1).write.mode("overwrite").parquet(f"{path}/load-{following:09d}")
            loads.append(following)
    found = wanted.alias("w").join(known().alias("k"), condition("w", "k"))
    return found.select("w.*", "number")


def _loads(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders that were written to their end."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    return [int(n.rpartition("-")[2]) for n in sorted(names) if scratch.exists(spark, f"{path}/{n}/_SUCCESS")]
