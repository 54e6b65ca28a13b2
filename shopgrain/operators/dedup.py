"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest_by`` values for each key.

    Remaining ties fall to the greatest row by its other columns, so the
    survivor does not depend on how the data is laid out. Written as a maximum
    and not as a row number: every task first reduces the copies it holds to
    one, hence a key with very many copies puts no load on a single task.
    """
    others = [c for c in df.columns if c not in keys and c not in newest_by]
    row = F.max(F.struct(*newest_by, *others)).alias("row")
    picked = df.groupBy(*keys).agg(row)
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns]
    )
