"""Named queries over the test tables, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cleaning, explore, files, gold, incremental, intents, quality, scalars

Builder = Callable[[SparkSession, str], DataFrame]

_MODULES = (files, cleaning, gold, explore, scalars, quality, incremental, intents)


def queries() -> dict[str, Builder]:
    return {name: build for module in _MODULES for name, (build, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        name: sql
        for module in _MODULES
        for name, (_, sql) in module.QUERIES.items()
        if sql is not None
    }
