"""Joins of facts with dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    facts: DataFrame, dimension: DataFrame, keys: str | Sequence[str], how: str = "left"
) -> DataFrame:
    """Add the columns of a dimension that has one row per key.

    No broadcast is forced: Spark broadcasts a dimension whose measured size is
    below its threshold and shuffles beyond it, and adaptive execution splits
    the partition of a hot key.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported lookup join: {how}")
    return facts.join(dimension, [keys] if isinstance(keys, str) else list(keys), how)


def unmatched(facts: DataFrame, dimension: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key the dimension does not have; a null key never matches."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return facts.join(dimension.select(*keys), keys, "left_anti")


def match(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    keep_both: bool = False,
) -> DataFrame:
    """Equi-join in which null keys match each other; keeps the left keys.

    ``keep_both`` is for full outer joins: the keys are the left's or else the
    right's.
    """
    renamed = right.withColumnsRenamed({k: f"_match_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_match_{k}"))
    joined = left.join(renamed, condition, how)
    if keep_both:
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"_match_{k}")) for k in keys})
    return joined.drop(*[f"_match_{k}" for k in keys])
