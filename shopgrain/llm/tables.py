"""Stored intermediate tables and small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import scratch

# Fixed value: what counts as white space in every word-based contract.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def store(df: DataFrame, label: str, *folders: str) -> DataFrame:
    """Write a frame once below the shared scratch folder and go on from the files."""
    spark = df.sparkSession
    path = scratch.new_path(spark, label)
    df.write.option("compression", "zstd").partitionBy(*folders).parquet(path)
    order = [f for f in df.schema if f.name not in folders] + [df.schema[c] for c in folders]
    schema = type(df.schema)(order)
    return spark.read.schema(schema).parquet(path)


def smaller_batches(spark: SparkSession, most: int = 16 << 20) -> None:
    """Batches that go to Python hold at most about this many bytes from now on in this
    session, unless it says less already. Records alone do not bound them: texts differ
    in length by orders of magnitude."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    said = spark.conf.get(key, "64m")
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(said) > most:
        spark.conf.set(key, str(most))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORDS)), F.lit(0)).cast("long")


def row_keys(id_column: str, text_column: str) -> list[Column]:
    """``key`` and ``tie``, 96 bits of hash over id and text: what is true of a text is
    found again under them for every row that has the same, whatever the type of ids."""
    both = (F.col(id_column), F.col(text_column))
    return [F.xxhash64(*both, F.lit(3)).alias("key"), F.hash(*both).alias("tie")]
