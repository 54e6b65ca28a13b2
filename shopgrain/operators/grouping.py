"""Grouped totals next to exact distinct counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_totals(
    df: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, Column],
    distinct: Mapping[str, str],
) -> DataFrame:
    """Totals and distinct counts per group of a stored table.

    Several distinct counts in one aggregation make Spark repeat every row, as
    wide as all measures together, once per count. Here each count is a narrow
    aggregation of its own over just its column, and the results, one row per
    group and partitioned alike, are joined. Each first groups by the counted
    value too, so a hot group is spread over all tasks. ``df`` is read once per
    count, which suits columnar tables; store anything costlier first.
    """
    # A struct equals another with nulls in the same places, so groups with a
    # null key find each other by a plain join.
    keyed = df.withColumn("_group", F.struct(*keys))
    result = keyed.groupBy("_group").agg(*[c.alias(name) for name, c in totals.items()])
    for name, column in distinct.items():
        counts = keyed.groupBy("_group").agg(F.count_distinct(column).alias(name))
        result = result.join(counts, "_group")
    return result.select("_group.*", *totals, *distinct)
