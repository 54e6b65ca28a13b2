"""Tables replaced in one step, and schemas remembered from delivery to delivery."""

import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopgrain import schemas
from shopgrain.plans.known_columns import known_columns, remember_schema
from shopgrain.sinks import publish_table, switch_table, write_version
from shopgrain.sources import read_bronze
from shopgrain.streaming import read_log


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex[:12]}"
    yield name
    spark.sql(f"drop table if exists {name}")


def test_readers_see_old_or_new_rows(spark, tmp_path, name):
    root = str(tmp_path / "table")
    publish_table(spark.range(3), name, root)
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    # Between the two steps, and after a run that broke there, nothing has changed.
    path = write_version(spark.range(5, 9), root)
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    early = spark.table(name)
    switch_table(spark, name, path)
    assert rows(spark.table(name)) == [(5,), (6,), (7,), (8,)]
    assert rows(early) == [(0,), (1,), (2,)]  # its files are still there
    # A frame that reads the table itself.
    publish_table(spark.table(name).where("id > 6"), name, root)
    assert rows(spark.table(name)) == [(7,), (8,)]
    publish_table(spark.table(name).where("id > 7"), name, root)
    assert rows(spark.table(name)) == [(8,)]
    assert sorted(p.name for p in (tmp_path / "table").iterdir()) == ["v-3", "v-4"]


def test_a_write_that_fails_leaves_the_table(spark, tmp_path, name):
    root = str(tmp_path / "table")
    publish_table(spark.range(3), name, root)
    failing = spark.range(3).select(F.when(F.col("id") < 5, F.raise_error(F.lit("no"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        publish_table(failing, name, root)
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    publish_table(spark.range(1), name, root)
    assert rows(spark.table(name)) == [(0,)]


def test_remembered_columns(spark, tmp_path, name):
    log, path = str(tmp_path / "log"), str(tmp_path / "data")

    def found(ddl):
        return spark.createDataFrame([], ddl).schema

    def changes(ddl, attached=None):
        news = remember_schema(spark, log, "people", found(ddl), attached)
        return rows(news, "column_name", "change", "data_type", "found_type")

    assert known_columns(spark, log, "people") == []
    first = "id long, name string, at struct<x: long>"
    assert changes(first) == [
        ("at", "added", "struct<x:bigint>", "struct<x:bigint>"), ("id", "added", "bigint", "bigint"), ("name", "added", "string", "string")
    ]
    spark.createDataFrame([(1, "a")], "id long, name string").write.json(path)
    spark.catalog.createTable(name, path=path, source="json", schema=found(first))
    assert changes(first) == []
    second = "id string, at struct<x: long>, `odd name` double"
    expected = [("id", "retyped", "bigint", "string"), ("name", "missing", "string", None), ("odd name", "added", "double", "double")]
    assert changes(second, name) == expected
    assert spark.table(name).columns == ["id", "name", "at", "odd name"]
    spark.createDataFrame([(2, 0.5)], "id long, `odd name` double").write.mode("append").json(path)
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name), "id", "name", "odd name") == [(1, "a", None), (2, None, 0.5)]
    versions = {r.version for r in read_log(spark, log, schemas.KNOWN_COLUMNS).collect()}
    assert versions == {1, 2}
    # It comes back: that is a version too.
    assert changes("id long, name string, at struct<x: long>, `odd name` double") == []
    latest = known_columns(spark, log, "people")
    assert [r.change for r in latest] == ["kept"] * 4 and latest[0].version == 3
    assert known_columns(spark, log, "others") == []


def test_files_of_several_kinds_in_odd_folders(spark, tmp_path):
    folder = tmp_path / "products" / "date=2024-01-01" / "with space & %"
    folder.mkdir(parents=True)
    (folder / "pretty.json").write_text('[\n  {"id": 1,\n   "title": "a"},\n  {"id": 2, "title": "b"}\n]')
    (folder / "lines.json").write_text('{"id": 3, "title": "c"}\n{"id": 4, "title": "d"}\n')
    (folder / "one line.json").write_text('[{"id": 5}, {"id": 6}]')
    found = read_bronze(spark, str(tmp_path / "products"), "products")
    assert rows(found, "id", "title") == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None), (6, None)]
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    (folder / "lines.json").unlink()
    (folder / "one line.json").unlink()
    assert read_bronze(spark, str(tmp_path / "products"), "products").count() == 2
