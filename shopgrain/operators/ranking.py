"""Ordered operators that never sort a whole group in one task.

A plain window sends each of its groups to one task, and a window without
groups sends the whole table to one. Here the values are cut into ranges of
about equal size first; each task orders one range, and a small table with one
row per range carries the totals forward.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import match

def _range_number(points: DataFrame, value: str, weight: str, ranges: int) -> DataFrame:
    """Add ``_range``: the number of cut values below ``value``, -1 for null.

    The cut values come from a subquery, which Spark evaluates once for all uses
    of the frame. The filter on the weight leaves it the same columns as the
    frame itself, so that it starts from the same shuffled points.
    """
    step = math.isqrt(ranges - 1) + 1
    fractions = [i / ranges for i in range(1, ranges)]
    # One row: all cut values, and each step-th of them to look those up by.
    weighted = points.filter(F.col(weight) > 0)
    cuts = weighted.agg(F.percentile_approx(value, fractions).alias("fine")).select(
        F.struct(
            "fine", F.expr(f"filter(fine, (c, i) -> (i + 1) % {step} = 0)").alias("coarse")
        )
    )
    located = points.withColumn("_cuts", cuts.scalar())

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda cut: cut < F.col(value)))

    located = located.withColumn("_coarse", below(F.col("_cuts.coarse")))
    block = F.slice(F.col("_cuts.fine"), F.col("_coarse") * step + 1, F.lit(step))
    number = F.when(F.col(value).isNull(), -1).otherwise(F.col("_coarse") * step + below(block))
    return located.withColumn("_range", number).drop("_cuts", "_coarse")


def running_total(
    points: DataFrame,
    value: str,
    weight: str,
    name: str,
    groups: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Sum of ``weight`` up to and including each ``value`` of its group.

    ``points`` has one row per group and value. Adds ``name`` and the group's
    ``<name>_of``, the sum over the whole group. Nulls come first, or last when
    descending.
    """
    groups = list(groups)
    if ranges is None:
        ranges = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(ranges, 2)
    placed = _range_number(points, value, weight, ranges)

    def direction(column: str) -> Column:
        return F.desc(column) if descending else F.asc(column)

    within = (
        Window.partitionBy(*groups, "_range")
        .orderBy(direction(value))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = placed.withColumn("_local", F.sum(weight).over(within))

    # At most ``ranges`` + 1 rows per group from here on.
    per_range = placed.groupBy(*groups, "_range").agg(F.sum(weight).alias("_in_range"))
    earlier = (
        Window.partitionBy(*groups)
        .orderBy(direction("_range"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_range.select(
        *groups,
        "_range",
        F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_in_range").over(Window.partitionBy(*groups)).alias("_of"),
    )
    joined = match(local, offsets, [*groups, "_range"])
    return joined.select(
        *points.columns,
        (F.col("_local") + F.col("_before")).alias(name),
        F.col("_of").alias(f"{name}_of"),
    )


def dense_rank(
    df: DataFrame,
    value: str,
    name: str,
    groups: Sequence[str] = (),
    descending: bool = True,
    ranges: int | None = None,
) -> DataFrame:
    """Dense rank of ``value`` within its group, as a long column ``name``.

    Only the distinct values are ordered; the rows then look their rank up, so
    a value that very many rows share is ordered once.
    """
    groups = list(groups)
    points = df.select(*groups, value).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    ranks = running_total(points, value, "_one", name, groups, descending, ranges)
    return match(df, ranks.select(*groups, value, name), [*groups, value])


def dense_ranks(
    df: DataFrame,
    value: str,
    names: Mapping[str, Sequence[str]],
    descending: bool = True,
    ranges: int | None = None,
) -> DataFrame:
    """Several dense ranks of one value: each name is the rank within its groups.

    The distinct values of all groups are cut into ranges and shuffled by range once;
    every rank is a window in a range, carried forward by the numbers of values that the
    ranges before have. ``df`` is read twice.
    """
    groups = list(dict.fromkeys(g for wanted in names.values() for g in wanted))
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = df.select(*groups, value).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    placed = _range_number(points, value, "_one", max(ranges, 2)).drop("_one").repartition("_range")

    def direction(column: str) -> Column:
        return F.desc(column) if descending else F.asc(column)

    for name, wanted in names.items():
        within = Window.partitionBy("_range", *wanted).orderBy(direction(value))
        placed = placed.withColumn(name, F.dense_rank().over(within).cast("bigint"))
    ranked = placed
    for name, wanted in names.items():
        # One row for each range and group.
        counts = placed.groupBy(*wanted, "_range").agg(F.max(name).alias("_in_range"))
        earlier = Window.partitionBy(*wanted).orderBy(direction("_range")).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_in_range").over(earlier), F.lit(0).cast("bigint"))
        offsets = counts.select(*wanted, "_range", before.alias("_before"))
        ranked = match(ranked, offsets, [*wanted, "_range"])
        ranked = ranked.withColumn(name, F.col(name) + F.col("_before")).drop("_before")
    return match(df, ranked.drop("_range"), [*groups, value])


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    groups: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles per group, interpolated between the two nearest values.

    Adds the group's number of values as ``n``. Null values are left out.
    """
    groups = list(groups)
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("_n"))
    )
    placed = running_total(counted, value, "_n", "_upto", groups, ranges=ranges)

    def at(index: Column) -> Column:
        hit = (F.col("_upto") - F.col("_n") <= index) & (index < F.col("_upto"))
        return F.max(F.when(hit, F.col(value).cast("double")))

    picked = [F.max("_upto_of").alias("n")]
    results = []
    for label, q in quantiles.items():
        position = F.lit(q) * (F.col("_upto_of") - 1)
        picked += [
            at(F.floor(position)).alias(f"_lo_{label}"),
            at(F.ceil(position)).alias(f"_hi_{label}"),
        ]
        where = F.lit(q) * (F.col("n") - 1)
        low, high = F.col(f"_lo_{label}"), F.col(f"_hi_{label}")
        results.append((low + (high - low) * (where - F.floor(where))).alias(label))
    return placed.groupBy(*groups).agg(*picked).select(*groups, "n", *results)
