"""Order items in and out of arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_items(df: DataFrame, array: str, fields: Mapping[str, str]) -> DataFrame:
    """One row per array element; rows with a null or empty array vanish.

    ``fields`` maps new column names to fields of the element.
    """
    others = [c for c in df.columns if c != array]
    exploded = df.select(*others, F.explode(array).alias("_element"))
    return exploded.select(
        *others, *[F.col(f"_element.{field}").alias(name) for name, field in fields.items()]
    )


def nest_items(
    df: DataFrame, keys: Sequence[str], fields: Mapping[str, Column], name: str
) -> DataFrame:
    """Gather items into one array of structs per key, sorted by its fields.

    There is one row per key at any size, as one bronze document holds a whole
    order: the items of one key must fit a row. Keys with unbounded items belong
    in a flat table.
    """
    item = F.struct(*[value.alias(field) for field, value in fields.items()]).alias("_item")
    return (
        df.select(*keys, item)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_item")).alias(name))
    )
