"""Schema discovery over raw folders and SQL over the discovered tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NumericType, StructType

from .bronze import BROKEN, OPENS, subfolders, unreadable


_KEY = re.compile(r"/([^/=]+)=[^/]*")


def _keyed(df: DataFrame, root: str, *others: DataFrame) -> DataFrame:
    """Add the ``key=value`` folders below a table's folder as text columns.

    A key that the documents, or those of the other frames, have themselves is
    called ``folder_<key>``.
    """
    taken = {c for frame in (df, *others) for c in frame.columns}
    below = [f.rpartition(f"/{root.rstrip('/').rpartition('/')[2]}/")[2] for f in df.inputFiles()]
    keys = dict.fromkeys(k for f in below for k in _KEY.findall(f"/{f.rpartition('/')[0]}"))
    file = F.col("_metadata.file_path")
    columns = {
        f"folder_{k}" if k in taken else k: F.nullif(
            F.regexp_extract(file, f"/{re.escape(k)}=([^/]*)/", 1), F.lit("")
        )
        for k in keys
    }
    return df.select("*", *[value.alias(name) for name, value in columns.items()])


def discover(
    spark: SparkSession, path: str, multi_line: bool | None = None, sampling_ratio: float = 1.0
) -> DataFrame:
    """A folder of JSON documents under the schema its documents show.

    By default each file is read as what it is, lines or a document. Folder keys
    become columns. With a ratio below one only a sample is looked at, so rare
    columns can stay undiscovered; the rows themselves are always all read.
    """

    def read(whole: bool, paths: str | list[str]) -> DataFrame:
        return (
            spark.read.option("multiLine", whole)
            .option("recursiveFileLookup", True)
            .option("samplingRatio", sampling_ratio)
            .option("columnNameOfCorruptRecord", BROKEN)
            .json(paths)
        )

    if multi_line is not None:
        return _keyed(read(multi_line, path), path)
    lines = read(False, path)
    if BROKEN not in lines.columns:
        return _keyed(lines, path)
    if lines.columns == [BROKEN]:
        return _keyed(read(True, path), path)
    schema = StructType([f for f in lines.schema if f.name != BROKEN])
    opening = unreadable(schema) & F.col(BROKEN).rlike(OPENS)
    file = F.col("_metadata.file_path")
    # As many names as files, of which the reader keeps a list itself.
    whole = sorted(r[0] for r in lines.filter(opening).select(file).distinct().collect())
    if not whole:
        return _keyed(lines.filter(~unreadable(schema)), path).drop(BROKEN)
    plain = lines.filter(~file.isin(whole) & ~unreadable(schema))
    documents = read(True, whole)
    return evolve([_keyed(plain, path, documents).drop(BROKEN), _keyed(documents, path, plain)])


def discover_all(spark: SparkSession, root: str, multi_line: bool | None = None) -> dict[str, DataFrame]:
    """Every table below a root, one for each of its folders, by name."""
    names = subfolders(spark, root) or []
    return {n: discover(spark, f"{root.rstrip('/')}/{n}", multi_line) for n in sorted(names)}


def column_list(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """What was discovered: a row for each column of each table."""
    rows = [(t, k, f.name, f.dataType.simpleString()) for t, df in tables.items() for k, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def schema_changes(old: StructType, new: StructType) -> dict[str, list[str]]:
    """Columns a delivery adds, lacks, or brings with another type."""
    before = {f.name: f.dataType for f in old}
    after = {f.name: f.dataType for f in new}
    return {
        "added": [c for c in after if c not in before],
        "missing": [c for c in before if c not in after],
        "retyped": [c for c in after if c in before and after[c] != before[c]],
    }


def _as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    nested = (ArrayType, MapType, StructType)
    return df.withColumns(
        {
            c: F.to_json(c) if isinstance(df.schema[c].dataType, nested) else F.col(c).cast("string")
            for c in columns
        }
    )


def _mergeable(old: DataType, new: DataType) -> bool:
    """Whether a union by name can bring two types together without text."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        shared = set(old.names) & set(new.names)
        return all(_mergeable(old[n].dataType, new[n].dataType) for n in shared)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return _mergeable(old.elementType, new.elementType)
    return old == new or (isinstance(old, NumericType) and isinstance(new, NumericType))


def _merge(old: DataFrame, new: DataFrame) -> DataFrame:
    def mixed(column: str) -> bool:
        return not _mergeable(old.schema[column].dataType, new.schema[column].dataType)

    changes = schema_changes(old.schema, new.schema)
    texts = [c for c in changes["retyped"] if mixed(c)]
    return _as_text(old, texts).unionByName(_as_text(new, texts), allowMissingColumns=True)


def evolve(batches: Iterable[DataFrame]) -> DataFrame:
    """All batches under one schema: new columns are added, old ones are kept.

    A column that is a number in one batch and text in another becomes text.
    """
    return reduce(_merge, batches)


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make frames available to SQL under the given names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def attach(spark: SparkSession, folders: Mapping[str, str], file_format: str = "parquet") -> None:
    """Create catalog tables over existing folders, without moving their files."""
    for name, path in folders.items():
        spark.catalog.createTable(name, path=path, source=file_format)


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL; frames passed by keyword are addressed as ``{name}`` in the text."""
    return spark.sql(sql, **frames) if frames else spark.sql(sql)
