"""Readers for bronze JSON documents.

Three layouts of day folders are known, and every sink of this package writes one
of them: ``date=`` and ``ingest_date=`` folders, and ``year=/month=/day=`` for
events. Files hold JSON lines, arrays or single objects, on one line or printed
over several; by default each file is read as what it turns out to be, found by a first
pass over the lines when the frame is made.
``multi_line=False`` (JSON lines and one-line arrays only, split between tasks) and
``multi_line=True`` (one document per file) skip the look at the files.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BRONZE

BROKEN = "_corrupt_record"
_FILE = "source_file"
# What files of documents are called: the JSON and the text writer's endings.
DOCUMENTS = "*.{json,txt,json.gz,txt.gz}"
_DAY = r"/(?:ingest_)?date=(\d{4}-\d{2}-\d{2})(?:/|$)"
_YMD = r"/year=(\d+)/month=(\d+)/day=(\d+)(?:/|$)"
# The first line of a document that goes on over more lines, or of any array.
OPENS = r"^\s*(\[|\{\s*$)"


def ingest_day(file: Column) -> Column:
    """The day that a file's folders name; null if they name none."""
    parts = [F.nullif(F.regexp_extract(file, _YMD, k), F.lit("")).cast("int") for k in (1, 2, 3)]
    named = F.nullif(F.regexp_extract(file, _DAY, 1), F.lit(""))
    return F.coalesce(F.to_date(named), F.make_date(*parts))


def with_ingest_day(df: DataFrame) -> DataFrame:
    """Add ``ingest_date`` and ``source_file`` to rows read from files."""
    file = F.col("_metadata.file_path")
    return df.select("*", ingest_day(file).alias("ingest_date"), file.alias(_FILE))


def unreadable(schema: StructType) -> Column:
    # A record with one bad field keeps its other fields; only a document that
    # could not be parsed at all has nothing but the raw text.
    # Written so that the parser does not get it as a filter: it would drop a row at
    # its first field, before it comes to the broken one.
    read = [F.when(F.col(f"`{f.name}`").isNotNull(), True) for f in schema]
    return F.col(BROKEN).isNotNull() & F.coalesce(*read).isNull()


def _records(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType,
    pattern: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Records with their file and, if unreadable, their text."""

    def read(whole: bool, files: str | list[str]) -> DataFrame:
        reader = (
            spark.read.schema(StructType([*schema, StructField(BROKEN, StringType())]))
            .option("multiLine", whole)
            .option("recursiveFileLookup", True)
            .option("columnNameOfCorruptRecord", BROKEN)
        )
        if pattern:
            reader = reader.option("pathGlobFilter", pattern)
        return reader.json(files).select("*", F.col("_metadata.file_path").alias(_FILE))

    if multi_line is not None:
        return read(multi_line, paths)
    lines = read(False, paths)
    # A line that opens a document and cannot be read on its own gives away a file
    # that has to be read as a whole. One row per such file; the driver lists files anyway.
    opens = lines.filter(unreadable(schema) & F.col(BROKEN).rlike(OPENS)).select(_FILE).distinct()
    whole = {_path(r[_FILE]) for r in opens.collect()}
    if not whole:
        return lines
    split = sorted({_path(f) for f in lines.inputFiles()} - whole)
    parts = [read(kind, files) for kind, files in ((False, split), (True, sorted(whole))) if files]
    return reduce(DataFrame.unionByName, parts)


def _path(uri: str) -> str:
    """The path behind a file's encoded name, in which an empty authority may be left out."""
    return unquote(re.sub(r"^([\w+.-]+):///", r"\1:/", uri))


def read_bronze(
    spark: SparkSession, path: str, table: str, multi_line: bool | None = None
) -> DataFrame:
    """All documents of a bronze table, over all its ingest days.

    Folder names are not turned into columns, because the day folder of the
    orders would replace their own ``date``. The ingest day and the file are
    added as ``ingest_date`` and ``source_file`` instead.
    """
    found = _records(spark, path, BRONZE[table], None, multi_line)
    return found.filter(~unreadable(BRONZE[table])).select(
        *BRONZE[table].names, ingest_day(F.col(_FILE)).alias("ingest_date"), _FILE
    )


def read_files(
    spark: SparkSession, files: list[str], table: str, multi_line: bool | None = None
) -> DataFrame:
    """The documents of some files of a bronze table, as ``read_bronze`` gives them."""
    found = _records(spark, files, BRONZE[table], None, multi_line)
    return found.filter(~unreadable(BRONZE[table])).select(
        *BRONZE[table].names, ingest_day(F.col(_FILE)).alias("ingest_date"), _FILE
    )


def subfolders(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the folders in a folder; None if there is no such folder."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    return [f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory()]


def read_day(
    spark: SparkSession,
    bronze_path: str,
    table: str,
    day: dt.date | str,
    scope: str = "partition",
    multi_line: bool | None = None,
) -> DataFrame:
    """Documents ingested on one day: the whole folder, or only its first file.

    A day without a folder, and a table that does not exist yet, have no documents.
    A table whose folders are not days is an error: nothing in it could be found.
    """
    if scope not in ("partition", "first_file"):
        raise ValueError(f"unknown scope: {scope}")
    day = dt.date.fromisoformat(str(day))
    root = f"{bronze_path.rstrip('/')}/{table}"
    names = subfolders(spark, root)
    known = [n for n in names or () if n.partition("=")[0] in ("date", "ingest_date", "year")]
    if names is not None and not known:
        raise ValueError(f"no day folders (date=, ingest_date= or year=/month=/day=) in {root}")
    folders = [f"date={day}", f"ingest_date={day}"]
    months = {f"{day.month:02d}", str(day.month)}
    days = {f"{day.day:02d}", str(day.day)}
    folders += [f"year={day.year}/month={m}/day={d}" for m in sorted(months) for d in sorted(days)]
    paths = [f"{root}/{f}" for f in folders if subfolders(spark, f"{root}/{f}") is not None]
    schema = BRONZE[table]
    if not paths:
        return spark.createDataFrame([], schema)
    if scope == "first_file":
        files = spark.read.option("recursiveFileLookup", True).text(paths).inputFiles()
        paths = [min(files)] if files else paths
    found = _records(spark, paths, schema, None, multi_line)
    return found.filter(~unreadable(schema)).select(*schema.names)


def _documents(
    spark: SparkSession, path: str, schema: StructType, pattern: str, multi_line: bool | None
) -> DataFrame | None:
    try:
        return _records(spark, path, schema, pattern, multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    pattern: str = DOCUMENTS,
    multi_line: bool | None = None,
) -> DataFrame:
    """Records of every matching file below ``path``.

    Files may hold a list, a single object or lines. Broken files and files that do
    not match ``pattern`` are left out; a missing path gives an empty frame.
    """
    frame = _documents(spark, path, schema, pattern, multi_line)
    if frame is None:
        return spark.createDataFrame([], schema)
    return frame.filter(~unreadable(schema)).select([f"`{name}`" for name in schema.names])


def skipped_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    pattern: str = DOCUMENTS,
    multi_line: bool | None = None,
) -> DataFrame:
    """Files that ``read_documents`` leaves out, whole or in part, because they
    cannot be parsed."""
    frame = _documents(spark, path, schema, pattern, multi_line)
    if frame is None:
        return spark.createDataFrame([], "file string, skipped bigint")
    return (
        frame.filter(unreadable(schema))
        .groupBy(F.col(_FILE).alias("file"))
        .agg(F.count("*").alias("skipped"))
    )
