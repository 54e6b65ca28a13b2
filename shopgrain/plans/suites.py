"""Data-quality suites of the bronze tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import NotNull, Range, RowCount, Unique, ValueSet, alert_report, check, verdict
from ..operators.quality import result_records
from ..sources import read_day

# The categories and row limits of a daily product delivery.
CATEGORIES = ("ELECTRONICS", "CLOTHING", "BOOKS", "HOME", "SPORTS", "TOYS")
MAX_PRODUCTS = 1000
MAX_CUSTOMERS = 10000


def products_suite(
    categories: tuple[str, ...] = CATEGORIES, max_rows: int = MAX_PRODUCTS
) -> list:
    return [
        NotNull("id"),
        NotNull("title"),
        NotNull("price"),
        Unique("id"),
        Range("price", 0, 10000),
        RowCount(1, max_rows),
        ValueSet("category", categories),
    ]


def customers_suite(max_rows: int = MAX_CUSTOMERS) -> list:
    return [
        NotNull("id"),
        NotNull("email"),
        Unique("id"),
        Unique("email"),
        RowCount(1, max_rows),
    ]


def orders_suite() -> list:
    return [NotNull("id"), NotNull("userId"), NotNull("date"), Unique("id"), RowCount(1)]


SUITES = {"products": products_suite, "customers": customers_suite, "orders": orders_suite}


def check_tables(tables: Mapping[str, DataFrame], suites: Mapping[str, list] | None = None) -> DataFrame:
    """Results of the suites over bronze tables; empty tables are not checked."""
    rules = suites or {name: SUITES[name]() for name in tables}
    results = [check(df, name, rules[name], skip_empty=True) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, results)


_SUMMARY = ("total_checks", "checks_passed", "checks_failed", "success_rate", "all_passed")


@dataclass(frozen=True)
class QualityRun:
    """What a run found: the stored records, the messages and the verdict."""

    records: DataFrame
    alerts: DataFrame
    verdict: DataFrame


def check_day(
    spark: SparkSession,
    bronze_path: str,
    day: dt.date | str,
    run_id: str,
    store: str,
    timestamp: dt.datetime | str,
    suites: Mapping[str, list] | None = None,
) -> QualityRun:
    """Check all bronze tables of an ingest day and store the results of the run.

    Results are kept in a folder per run, so repeating a run replaces its own.
    Tables without documents on that day are not checked; a table in an unknown
    layout is an error, as nothing in it would be found.
    """
    names = suites or SUITES
    tables = {name: read_day(spark, bronze_path, name, day) for name in names}
    records = result_records(check_tables(tables, suites), run_id, timestamp)
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id"
    ).parquet(store)
    schema = records.schema
    stored = spark.read.schema(schema).parquet(store).filter(F.col("run_id") == F.lit(run_id))
    summaries = stored.select("table_name", *_SUMMARY)
    return QualityRun(
        stored.select(schema.names), alert_report(summaries), verdict(summaries, run_id, day)
    )
