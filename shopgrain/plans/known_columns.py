"""Discovered schemas that are remembered from delivery to delivery.

A log keeps a version of a table's columns whenever a delivery brings a change. A new
column updates the table in the catalog, one that is missing is noted and stays, and one
of another type is noted and keeps the type it has, so that earlier and later rows stay
readable under one schema.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import KNOWN_COLUMNS
from ..sources import schema_changes
from ..streaming import append_log, read_log


def known_columns(spark: SparkSession, log: str, table: str) -> list:
    """Rows of the latest version, in the order of the columns; none before the first."""
    rows = read_log(spark, log, KNOWN_COLUMNS).where(F.col("table_name") == table)
    latest = rows.where(F.col("version") == rows.agg(F.max("version")).first()[0])
    return latest.orderBy("position").collect()  # one row for each column


def remember_schema(
    spark: SparkSession,
    log: str,
    table: str,
    found: StructType,
    attached: str | None = None,
    timestamp: dt.datetime | str | None = None,
) -> DataFrame:
    """Compare a delivery's schema with what is known, note what changed, and return the
    changes (the rows of ``KNOWN_COLUMNS`` that are not kept).

    ``attached`` names a catalog table over the deliveries, which gets the new columns.
    Columns are added before they are noted and only where the table lacks them, so a
    call that broke can be repeated. A delivery without a change leaves no version.
    """
    known = known_columns(spark, log, table)
    old = spark.createDataFrame([], ", ".join(f"`{r.column_name}` {r.data_type}" for r in known)).schema if known else StructType()
    changes = schema_changes(old, found)
    types = {f.name: f.dataType.simpleString() for f in found}
    was = {c for r in known if r.change == "missing" for c in [r.column_name]}
    # Missing once more is no news, and neither is a type known to differ.
    seen = {(r.column_name, r.change, r.found_type) for r in known}
    rows = []
    for k, name in enumerate([*old.names, *changes["added"]]):
        kept = {f.name: f.dataType.simpleString() for f in old}.get(name)
        change = next((c for c in ("added", "missing", "retyped") if name in changes[c]), "kept")
        rows.append((table, name, kept or types[name], types.get(name), change, k))
    news = [r for r in rows if r[4] != "kept" and (r[1], r[4], r[3]) not in seen] + [r for r in rows if r[4] == "kept" and r[1] in was]
    version = (known[0].version if known else 0) + 1
    now = F.current_timestamp() if timestamp is None else F.lit(timestamp).cast("timestamp")
    noted = spark.createDataFrame(
        [(t, version, k, name, kept, type_, change) for t, name, kept, type_, change, k in rows if news],
        KNOWN_COLUMNS[:-1],
    ).withColumn("noted_at", now)
    if news:
        if attached is not None:
            there = set(spark.table(attached).columns)
            new = [f"`{c}` {types[c]}" for c in changes["added"] if c not in there]
            if new:
                spark.sql(f"alter table {attached} add columns ({', '.join(new)})")
        append_log(noted.coalesce(1), log)
    return noted.where("change <> 'kept'")
