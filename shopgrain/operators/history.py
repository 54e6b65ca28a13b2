"""Keys and row versions of slowly changing dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import match

# Fixed value: the expiration date of a version that is still open.
OPEN_END = "2099-12-31"


def surrogate_key(*columns: str | Column) -> Column:
    """Key computed from the row itself: equal on every run and cluster layout."""
    return F.xxhash64(*columns)


def open_versions(
    df: DataFrame, key_name: str, business_key: str | Column, load_time: Column
) -> DataFrame:
    """Stamp every row as the current version of its business key."""
    return (
        df.withColumns(
            {
                "effective_date": F.to_date(load_time),
                "expiration_date": F.lit(OPEN_END).cast("date"),
                "is_current": F.lit(True),
                "load_timestamp": load_time,
            }
        ).withColumn(key_name, surrogate_key(business_key, "effective_date"))
    )


def valid_on(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    day: str | Column,
    *columns: str,
    first_before: bool = True,
) -> DataFrame:
    """Facts with columns of the version of their key that was valid on their day.

    A version is valid from its effective date up to the day before its expiration
    date. With ``first_before`` the first version of a key is valid before its effective
    date too, as a history begins only with the first load. Facts without a valid version
    have nulls. An equi-join on the key, with the interval as a condition on the pairs that
    it finds: every fact meets its key's few versions, and a hot key's partition is split.
    """
    on = F.col(day) if isinstance(day, str) else day
    first = F.min("effective_date").over(Window.partitionBy(key))
    begins = F.col("effective_date")
    if first_before:
        begins = F.when(begins == first, F.lit("0001-01-01").cast("date")).otherwise(begins)
    versions = history.select(
        F.col(key).alias("_key"), begins.alias("_from"), F.col("expiration_date").alias("_until"), *columns
    )
    valid = (F.col(key) == F.col("_key")) & (F.col("_from") <= on) & (on < F.col("_until"))
    return facts.join(versions, valid, "left").drop("_key", "_from", "_until")


def merge_history(
    history: DataFrame,
    snapshot: DataFrame,
    key_name: str,
    business_key: str | Column,
    tracked: Sequence[str],
    as_of: dt.date,
    close_missing: bool = False,
) -> DataFrame:
    """History after loading a full snapshot of the source.

    Both frames have the same columns; the snapshot has one row per business
    key, which may be null once. A current row whose tracked columns differ from
    the snapshot's is closed and the snapshot's row is opened next to it; unknown
    keys are opened; rows gone from the source stay open unless ``close_missing``.
    A version opened on the same day is replaced instead of closed, so a day has
    one version of a key at most and loading a snapshot again changes nothing.
    Write the result to a new path, never over the history being read.
    """
    columns = history.columns
    key = F.col(business_key) if isinstance(business_key, str) else business_key
    old = history.filter("is_current").select(key.alias("key"), F.struct(*columns).alias("old"))
    new = snapshot.select(key.alias("key"), F.struct(*columns).alias("new"))
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    today = F.lit(as_of).cast("date")
    ended = F.col("new").isNull() if close_missing else F.lit(False)
    changed = F.col("old").isNotNull() & ((F.col("new").isNotNull() & ~same) | ended)
    kept = F.col("old").isNotNull() & ~changed
    replaced = F.col("new").isNotNull() & (F.col("old.effective_date") == today)

    closed = F.col("old").withField("expiration_date", today).withField("is_current", F.lit(False))
    stamped = (
        F.col("new")
        .withField("effective_date", today)
        .withField("expiration_date", F.lit(OPEN_END).cast("date"))
        .withField("is_current", F.lit(True))
        .withField(key_name, surrogate_key("key", today))
    )
    versions = F.array(
        F.when(kept, F.col("old")).when(changed & ~F.coalesce(replaced, F.lit(False)), closed),
        F.when(F.col("new").isNotNull() & ~kept, stamped),
    )
    merged = (
        match(old, new, ["key"], "full_outer", keep_both=True)
        .select(F.explode(versions).alias("row"))
        .filter(F.col("row").isNotNull())
        .select("row.*")
    )
    return history.filter(~F.col("is_current")).unionByName(merged)
