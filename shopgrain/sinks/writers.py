"""Writers for every layer."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    incremental: bool = False,
    gathered: bool = False,
) -> None:
    """Overwrite a Parquet table.

    A full rebuild replaces the whole table, so no row stays behind in a folder
    it no longer belongs to; ``incremental`` replaces only the folders that the
    new rows fall into. Rows are rebalanced on the folder columns first: few
    files per folder, and a hot folder is still split between tasks; ``gathered``
    says that they come like that. Folders cannot tell an empty text from null, so an
    empty folder value is stored as null.
    """
    kinds = dict(df.dtypes)
    empty = {c: F.nullif(F.col(c), F.lit("")) for c in partition_by if kinds[c] == "string"}
    if empty:
        df = df.withColumns(empty)
    if partition_by and not gathered:
        df = df.hint("rebalance", *partition_by)
    writer = (
        df.write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic" if incremental else "static")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bronze_json(
    df: DataFrame,
    path: str,
    day: str | Column,
    mode: str = "append",
    gathered: bool = False,
    compression: str = "none",
) -> None:
    """JSON lines, one folder per ingest day; ``gathered`` as in ``write_table``. Files that
    are compressed cannot be split between tasks that read them.

    The folder column is called ``ingest_date`` to keep it apart from the order
    documents' own ``date``.
    """
    column = F.col(day) if isinstance(day, str) else day
    dated = df.withColumn("ingest_date", column.cast("date"))
    if not gathered:
        dated = dated.hint("rebalance", "ingest_date")
    dated.write.mode(mode).partitionBy("ingest_date").json(path, compression=compression)


def write_events(df: DataFrame, path: str, day: Column, mode: str = "append") -> None:
    """JSON lines by year / month / day folders, month and day with two digits."""
    folders = {
        "year": F.year(day).cast("string"),
        "month": F.lpad(F.month(day).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
    }
    (
        df.withColumns(folders)
        .hint("rebalance", *folders)
        .write.mode(mode)
        .partitionBy(*folders)
        .json(path)
    )


def _join_records(rows_per_document: int):
    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Null days go by an empty text, which no day has.
            for day, records in batch.fillna({"date": ""}).groupby("date")["record"]:
                for start in range(0, len(records), rows_per_document):
                    text = ",".join(records.iloc[start : start + rows_per_document])
                    yield pd.DataFrame({"date": [day], "value": [f"[{text}]"]}, dtype="object")

    return arrays


def write_documents(
    df: DataFrame,
    path: str,
    day: str | None = None,
    rows_per_document: int = 10_000,
    mode: str = "append",
) -> None:
    """Files that hold one JSON array each, below ``date=<day>`` folders if asked.

    Every task joins the records of its own batches to arrays. So documents stay
    small however the days are distributed, and a task that has to run again
    writes the same records again, wherever it cuts the arrays.
    """
    fields = [c for c in df.columns if c != day]
    folder = F.date_format(day, "yyyy-MM-dd") if day else F.lit("")
    records = df.select(folder.alias("date"), F.to_json(F.struct(*fields)).alias("record"))
    if day:
        records = records.hint("rebalance", "date")
    arrays = records.mapInPandas(_join_records(rows_per_document), "date string, value string")
    if day:
        arrays = arrays.withColumn("date", F.nullif("date", F.lit("")))
    else:
        arrays = arrays.drop("date")
    writer = arrays.write.mode(mode).option("maxRecordsPerFile", 1)
    if day:
        writer = writer.partitionBy("date")
    writer.text(path)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def run_summary(tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows in, out and removed per table, from (input, output) frames.

    Counted from the frames rather than by counters inside the writing job: a
    counter adds up twice when a lost executor makes its tasks run again.
    Pass the output as read back from its table, where a count is a footer read.
    """
    counts = []
    for name, (source, result) in tables.items():
        for rows_in, frame in ((True, source), (False, result)):
            n = F.count("*")
            counts.append(
                frame.agg(
                    F.lit(name).alias("table_name"),
                    (n if rows_in else F.lit(0).cast("bigint")).alias("rows_in"),
                    (F.lit(0).cast("bigint") if rows_in else n).alias("rows_out"),
                )
            )
    return (
        reduce(DataFrame.unionAll, counts)
        .groupBy("table_name")
        .agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))
        .withColumn("removed", F.col("rows_in") - F.col("rows_out"))
    )
