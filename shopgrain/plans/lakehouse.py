"""Runs that build and store the layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas, scratch
from ..functions import RfmThresholds
from ..operators import merge_history
from ..session import fitted_shuffles, small_scans, stored_bytes
from ..sinks import write_table
from ..sources import read_bronze, read_table
from . import gold, silver

SILVER = ("dim_products", "dim_customers", "dim_date", "fact_orders", "events")
GOLD = (
    "daily_sales_summary",
    "product_performance",
    "customer_360",
    "category_analysis",
    "cohort_analysis",
)
# Bytes, as stored, of a table of which a join sends a few columns to all tasks.
_SMALL = 48 * 1024**2
# What a version of a dimension row says about itself; the rest is tracked.
_STAMPS = ("effective_date", "expiration_date", "is_current", "load_timestamp")
_DIMENSIONS = {
    "dim_products": ("product_key", ("product_id",)),
    "dim_customers": ("customer_key", ("customer_id", "email")),
}


@dataclass(frozen=True)
class Lakehouse:
    """Silver and gold tables below one root folder.

    Every table is written once and read back by the steps that follow it, so
    no step recomputes an earlier one. Shuffles are fitted to the bytes that a
    step reads.
    """

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        layer = "silver" if name in (*SILVER, "rejected_orders") else "gold"
        return f"{self.root}/{layer}/{name}"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name).rpartition("/")[0], name)

    def exists(self, name: str) -> bool:
        return scratch.exists(self.spark, self.path(name))

    def small(self, *names: str) -> bool:
        """Whether each of these tables is small enough for every task to hold its keys."""
        return all(stored_bytes(self.spark, [self.path(n)]) <= _SMALL for n in names)

    def _store(self, name: str, df: DataFrame) -> None:
        write_table(df, self.path(name), schemas.PARTITIONING[name])

    def _store_dimension(self, name: str, snapshot: DataFrame, as_of: dt.date | None) -> None:
        """Overwrite, or merge into the stored history if there is one. Two rows under one
        surrogate key are an error, found before the table is replaced."""
        key_name, _ = _DIMENSIONS[name]
        with scratch.materialized(self._versions(name, snapshot, as_of), name) as stored:
            twice = stored.groupBy(key_name).count().filter("count > 1")
            if not twice.isEmpty():
                raise ValueError(f"{name}: one {key_name} for several rows, such as {twice.first()[0]}")
            self._store(name, stored)

    def _versions(self, name: str, snapshot: DataFrame, as_of: dt.date | None) -> DataFrame:
        if as_of is not None and self.exists(name):
            key_name, identity = _DIMENSIONS[name]
            tracked = [c for c in snapshot.columns if c not in (key_name, *_STAMPS)]
            return merge_history(
                self.table(name), snapshot, key_name, F.coalesce(*identity), tracked, as_of
            )
        return snapshot

    def build_dimensions(
        self,
        bronze: Mapping[str, DataFrame],
        as_of: dt.datetime | str | None = None,
        history: bool = False,
    ) -> None:
        """Products and customers; ``history`` keeps their earlier versions."""
        for table in ("products", "customers"):
            self.build_dimension(table, bronze[table], as_of, history)

    def build_dimension(
        self,
        table: str,
        documents: DataFrame,
        as_of: dt.datetime | str | None = None,
        history: bool = False,
    ) -> None:
        """One dimension from all documents of ``products`` or ``customers``."""
        day = None
        if history:
            day = dt.date.fromisoformat(str(as_of)[:10]) if as_of else dt.date.today()
        clean = {"products": silver.clean_products, "customers": silver.clean_customers}[table]
        self._store_dimension(f"dim_{table}", clean(documents, as_of), day)

    def build_silver(
        self,
        bronze: Mapping[str, DataFrame],
        as_of: dt.datetime | str | None = None,
        calendar: tuple[dt.date | str, dt.date | str] | None = None,
        dedup_orders: bool = False,
        history: bool = False,
        inputs: Iterable[str] = (),
    ) -> None:
        """Dimensions first, then the fact that refers to them, then calendar and events.

        Without given bounds the calendar spans the order days of the fact.
        ``inputs`` are the folders behind the frames, for the size of shuffles.
        """
        # Items are sorted by order where they are read, which small scans do in memory.
        with fitted_shuffles(self.spark, inputs), small_scans(self.spark):
            self.build_dimensions(bronze, as_of, history)
            dimensions = ("dim_products", "dim_customers")
            sold = silver.items_by_month(
                silver.ordered(bronze["orders"], dedup_orders), *map(self.table, dimensions), self.small(*dimensions)
            )
            fact = silver.measured_items(sold, as_of)
            write_table(fact, self.path("fact_orders"), schemas.PARTITIONING["fact_orders"], gathered=True)
            start, end = calendar or (None, None)
            days = silver.date_dimension(
                self.spark, start, end, F.col("order_date"), self.table("fact_orders")
            )
            self._store("dim_date", days)
            if "events" in bronze:
                self._store("events", silver.clean_events(bronze["events"]))

    def extend_calendar(self, start: dt.date, end: dt.date) -> None:
        """Make the stored calendar cover these days too."""
        if self.exists("dim_date"):
            known = self.table("dim_date").agg(F.min("date"), F.max("date")).first()
            if known[0] is not None and known[0] <= start and known[1] >= end:
                return
            start, end = min(start, known[0] or start), max(end, known[1] or end)
        self._store("dim_date", silver.date_dimension(self.spark, start, end))

    def build_gold(
        self,
        as_of: dt.datetime | str | None = None,
        thresholds: RfmThresholds = RfmThresholds(),
        today: dt.date | None = None,
    ) -> None:
        fact = self.table("fact_orders")
        products, customers = self.table("dim_products"), self.table("dim_customers")
        with fitted_shuffles(self.spark, [self.path("fact_orders"), self.path("dim_customers")]):
            self._store("daily_sales_summary", gold.daily_sales(fact, self.table("dim_date"), as_of))
            self._store("product_performance", gold.product_performance(fact, products, as_of))
            self._store(
                "customer_360", gold.customer_360(fact, customers, as_of, thresholds, today)
            )
            self._store("category_analysis", gold.category_analysis(fact, as_of))
            self._store("cohort_analysis", gold.cohort_analysis(fact, as_of))


def build_from_folder(
    spark: SparkSession,
    bronze_path: str,
    root: str,
    multi_line: bool | None = None,
    history: bool = False,
    as_of: dt.datetime | str | None = None,
) -> Lakehouse:
    """Both layers from a folder of bronze documents."""
    folders = {n: f"{bronze_path.rstrip('/')}/{n}" for n in ("products", "customers", "orders", "events")}
    context = spark.sparkContext
    events = context._jvm.org.apache.hadoop.fs.Path(folders["events"])
    if not events.getFileSystem(context._jsc.hadoopConfiguration()).exists(events):
        del folders["events"]
    tables = {n: read_bronze(spark, path, n, multi_line) for n, path in folders.items()}
    house = Lakehouse(spark, root)
    house.build_silver(tables, as_of, history=history, inputs=folders.values())
    house.build_gold(as_of)
    return house
