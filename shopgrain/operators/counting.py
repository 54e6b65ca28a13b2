"""Counts, shares and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import match


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, equal counts by value; nulls left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc(column))
    )


def share_of_total(counts: DataFrame, count: str = "count") -> DataFrame:
    """Add each row's ``share`` of the summed counts."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn("share", F.col(count) / total)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        frame.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def histogram(
    df: DataFrame, value: Column, bins: int = 20, groups: Sequence[str] = ()
) -> DataFrame:
    """Rows in equally wide bins between each group's least and greatest value.

    ``value`` is taken in hundredths so that bin edges are exact. The greatest
    value belongs to the last bin; empty bins have no row.
    """
    groups = list(groups)
    counted = (
        df.select(*groups, F.round(value.cast("decimal(20,4)") * 100).cast("bigint").alias("_v"))
        .filter(F.col("_v").isNotNull())
        .groupBy(*groups, "_v")
        .agg(F.count("*").alias("_n"))
    )
    bounds = counted.groupBy(*groups).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    if groups:
        joined = match(counted, bounds, groups)
    else:
        joined = counted.withColumns(
            {"_lo": bounds.select("_lo").scalar(), "_hi": bounds.select("_hi").scalar()}
        )
    width = F.col("_hi") - F.col("_lo")
    position = F.expr(f"(_v - _lo) * {int(bins)} div (_hi - _lo)")
    number = F.when(width == 0, F.lit(1)).otherwise(F.least(position + 1, F.lit(bins)))
    edges = joined.withColumn("bin", number.cast("int"))
    low = F.col("_lo") + width * (F.col("bin") - 1) / bins
    high = F.col("_lo") + width * F.col("bin") / bins
    return (
        edges.groupBy(*groups, "bin", (low / 100).alias("bin_start"), (high / 100).alias("bin_end"))
        .agg(F.sum("_n").alias("count"))
        .orderBy(*groups, "bin")
    )
