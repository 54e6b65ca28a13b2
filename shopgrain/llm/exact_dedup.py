"""Exact duplicates by distributed MSD radix partitioning.

Documents start as one group. Each round splits every group by the next digit,
a run of successive bytes, until a group has one member (nothing equals it) or
its texts have ended (all members are equal). Equality is decided by the bytes
themselves; no digest takes part. Digits widen from round to round, so the number
of rounds grows with the logarithm of the longest text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import SPACES, store, text_or_empty


def normalised(column: str):
    """Each run of white space becomes one space; null becomes the empty text."""
    return F.regexp_replace(text_or_empty(column), SPACES, " ")


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    first_digit: int = 64,
    growth: int = 16,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the smallest id is kept. A null text counts as
    empty. Null ids lose against any other id; if all ids of a group are null,
    keep_id is null and one of the rows is kept. Of rows that share id and text
    exactly one can be kept. Other columns are ignored. An empty table gives an
    empty result.

    Groups are counted with partial sums before any shuffle, and rows meet their
    group in a join, whose hot keys adaptive execution splits: no group is ever
    gathered.
    """
    text = normalised(text_column)
    active = docs.select(
        F.col(id_column).alias("id"),
        F.sha2(text.cast("binary"), 256).alias("sha"),
        F.lit(0).cast("long").alias("group"),
        text.cast("binary").alias("rest"),
    )
    width, finished, first = first_digit, [], True
    while True:
        rows = active.withColumn("digit", F.substring("rest", 1, width))
        # Rows get their number when they are first stored, so the first round
        # only splits; what ended in it is settled in the second.
        token = F.lit(None).cast("long") if first else F.col("token")
        groups = (
            rows.withColumn("token", token)
            .groupBy("group", "digit")
            .agg(
                F.count(F.lit(1)).alias("size"),
                F.min("id").alias("keep_id"),
                F.coalesce(F.min_by("token", "id"), F.min("token")).alias("keep_token"),
            )
            .where("size > 1")
            .withColumn("next_group", F.monotonically_increasing_id())
        )
        groups = store(groups, "radix-groups")
        # Merged at every size: a small table of groups would be broadcast otherwise,
        # and the plan for much data would never be the one that was tried.
        joined = rows.join(groups.hint("merge"), ["group", "digit"], "left")
        alone = F.col("size").isNull()
        ended = F.lit(False) if first else F.length("digit") < width
        done = alone | ended
        kept = F.lit(True) if first else alone | (F.col("token") == F.col("keep_token"))
        table = store(
            joined.select(
                "id",
                "sha",
                F.when(alone, F.col("id")).when(done, F.col("keep_id")).alias("keep_id"),
                F.when(done, F.coalesce("size", F.lit(1)).cast("long")).alias("group_size"),
                F.when(done, kept).alias("kept"),
                F.when(~done, F.col("next_group")).alias("group"),
                F.when(~done, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
                (F.monotonically_increasing_id() if first else F.col("token")).alias("token"),
                done.alias("done"),
            ),
            "radix-rows",
            "done",
        )
        finished.append(table.where("done"))
        active = table.where("not done").select("id", "sha", "group", "rest", "token")
        if active.isEmpty():
            break
        width, first = width * growth, False
    return reduce(DataFrame.unionByName, finished).select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )
