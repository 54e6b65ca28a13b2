import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopgrain import schemas
from shopgrain.operators import merge_history, open_versions
from shopgrain.sinks import write_bronze_json, write_table
from shopgrain.streaming import incremental
from shopgrain.streaming import (
    current_watermarks,
    filter_since,
    last_run,
    load_available,
    record_run,
    upsert_orders,
)


def test_watermarks(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert last_run(spark, path, "orders") is None
    assert current_watermarks(spark, path).count() == 0
    assert record_run(spark, path, "orders", "2024-01-01", "2024-01-01 10:00:00")
    assert record_run(spark, path, "orders", "2024-01-02", "2024-01-02 10:00:00")
    assert record_run(spark, path, "events", "2024-01-01")
    assert last_run(spark, path, "orders") == dt.date(2024, 1, 2)
    assert current_watermarks(spark, path).count() == 2


def test_failed_watermark_only_warns(spark, tmp_path):
    (tmp_path / "file").write_text("no folder")
    with pytest.warns(UserWarning, match="could not update"):
        assert not record_run(spark, str(tmp_path / "file" / "x"), "orders", "2024-01-01")


def test_filter_since(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-05')) as d")
    assert filter_since(df, "d", None).count() == 5
    assert filter_since(df, "d", "2024-01-03").count() == 2
    assert filter_since(df, F.col("d"), dt.date(2024, 1, 5)).count() == 0


def test_stream_takes_new_files_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))

    def load():
        load_available(
            spark, source, target, schemas.struct(id="long"), checkpoint,
            transform=lambda batch: batch.withColumn("double", F.col("id") * 2),
        )
        return rows(spark.read.parquet(target), "id", "double", "batch_id")

    spark.range(2).coalesce(1).write.json(source)
    assert load() == [(0, 0, 0), (1, 2, 0)]
    assert load() == [(0, 0, 0), (1, 2, 0)]
    spark.range(7, 8).coalesce(1).write.mode("append").json(source)
    assert load() == [(0, 0, 0), (1, 2, 0), (7, 14, 1)]


def items(spark, *data):
    base = spark.createDataFrame(
        data, "order_id string, order_date date, product_id string, revenue decimal(10,2)"
    )
    filled = base.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    missing = [f for f in schemas.FACT_ORDERS if f.name not in filled.columns]
    return filled.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(
        schemas.FACT_ORDERS.names
    )


def test_upsert_orders(spark, tmp_path):
    path = str(tmp_path / "fact")
    d, m = dt.date, Decimal
    stored = items(
        spark,
        ("1", d(2024, 1, 5), "a", m(1)), ("1", d(2024, 1, 5), "a", m(1)), ("2", d(2024, 1, 6), "a", m(2)),
        ("3", d(2024, 2, 1), "b", m(3)), ("9", d(2024, 5, 1), "b", m(9)), ("8", None, "b", m(8)),
    )
    write_table(stored, path, ["year", "month"])
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "month=5" in f}
    new = items(
        spark, ("1", d(2024, 1, 5), "a", m(10)), ("3", d(2024, 3, 1), "b", m(30)), ("4", d(2024, 3, 2), "c", m(4))
    )
    expected = [("1", m("10.00")), ("2", m("2.00")), ("3", m("30.00")), ("4", m("4.00")), ("8", m("8.00")), ("9", m("9.00"))]
    for _ in range(2):
        upsert_orders(spark, path, new)
        found = rows(spark.read.parquet(path), "order_id", "revenue", "month")
        # Order 3 moved away from February, whose folder is then empty.
        assert [f[:2] for f in found] == expected
    assert untouched <= set(spark.read.parquet(path).inputFiles())


@pytest.mark.parametrize("close_missing", [False, True])
def test_merge_history(spark, close_missing):
    schema = "id string, price int, kind string"
    loaded = F.lit("2024-01-01 00:00:00").cast("timestamp")

    def dim(*data):
        return open_versions(spark.createDataFrame(data, schema), "key", "id", loaded)

    history = dim(("same", 1, "x"), ("dearer", 1, "x"), ("gone", 1, "x"), ("nulled", 1, "x"))
    snapshot = dim(("same", 1, "y"), ("dearer", 2, "x"), ("new", 5, "x"), ("nulled", None, "x"))
    args = ("key", "id", ["price"])
    merged = merge_history(history, snapshot, *args, dt.date(2024, 2, 1), close_missing)
    shown = ["id", "price", "is_current", F.col("effective_date").cast("string"), F.col("expiration_date").cast("string")]
    ends = "2024-02-01" if close_missing else "2099-12-31"
    assert rows(merged, *shown) == [
        ("dearer", 1, False, "2024-01-01", "2024-02-01"),
        ("dearer", 2, True, "2024-02-01", "2099-12-31"),
        ("gone", 1, not close_missing, "2024-01-01", ends),
        ("new", 5, True, "2024-02-01", "2099-12-31"),
        ("nulled", 1, False, "2024-01-01", "2024-02-01"),
        ("nulled", None, True, "2024-02-01", "2099-12-31"),
        ("same", 1, True, "2024-01-01", "2099-12-31"),
    ]
    assert merged.select("key").distinct().count() == 7
    again = merge_history(merged, snapshot, *args, dt.date(2024, 3, 1), close_missing)
    assert rows(again, *shown) == rows(merged, *shown)


def test_upsert_within_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    d, m = dt.date, Decimal
    write_table(items(spark, ("1", d(2024, 1, 5), "a", m(1)), ("2", d(2024, 2, 5), "a", m(2))), path, ["year", "month"])
    upsert_orders(spark, path, items(spark, ("1", d(2024, 1, 5), "a", m(9))))
    upsert_orders(spark, path, items(spark, ("1", d(2024, 1, 5), "a", m(9))).filter("false"))
    assert rows(spark.read.parquet(path), "order_id", "revenue") == [("1", m("9.00")), ("2", m("2.00"))]


def history_of(spark, data, day):
    df = spark.createDataFrame(data, "key string, v int")
    return open_versions(df, "sk", "key", F.lit(f"{day} 08:00:00").cast("timestamp"))


def test_history_with_a_null_key_and_a_second_load_on_one_day(spark):
    args = "sk", "key", ["v"]
    shown = "key", "v", F.col("effective_date").cast("string"), "is_current"
    first = history_of(spark, [("a", 1), (None, 1)], "2024-01-01")
    merged = merge_history(first, history_of(spark, [("a", 2), (None, 1)], "2024-02-01"), *args, dt.date(2024, 2, 1))
    assert rows(merged, *shown) == [
        ("a", 1, "2024-01-01", False), ("a", 2, "2024-02-01", True), (None, 1, "2024-01-01", True),
    ]
    again = merge_history(merged, history_of(spark, [("a", 3), (None, 1)], "2024-02-01"), *args, dt.date(2024, 2, 1))
    assert rows(again, *shown) == [
        ("a", 1, "2024-01-01", False), ("a", 3, "2024-02-01", True), (None, 1, "2024-01-01", True),
    ]
    assert again.select("sk").distinct().count() == 3


def test_a_new_checkpoint_keeps_earlier_rows(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    day = F.lit("2024-05-02").cast("date")
    orders = spark.createDataFrame([(1, "2024-01-01")], "id long, date string")
    write_bronze_json(orders, source, day)
    load_available(spark, source, target, schemas.BRONZE["orders"], str(tmp_path / "c1"))
    for file in (tmp_path / "in").rglob("*.json"):
        file.unlink()
    write_bronze_json(orders.withColumn("id", F.lit(2)), source, day)
    load_available(spark, source, target, schemas.BRONZE["orders"], str(tmp_path / "c2"))
    found = rows(spark.read.parquet(target), "id", "date", F.col("ingest_date").cast("string"))
    assert found == [(1, "2024-01-01", "2024-05-02"), (2, "2024-01-01", "2024-05-02")]


def test_upsert_moves_only_what_it_must(spark, tmp_path, monkeypatch):
    """Months that lose all rows or none are not joined, nothing is stored twice, and new
    items that are stored by month are not moved."""
    copies, written = [], []
    copy, write = incremental.scratch.materialized, incremental.write_table
    monkeypatch.setattr(incremental.scratch, "materialized", lambda df, label: (copies.append(label), copy(df, label))[1])
    monkeypatch.setattr(incremental, "write_table", lambda df, *a, **k: (written.append((df, k["gathered"])), write(df, *a, **k)))
    d, m = dt.date, Decimal
    path, source = str(tmp_path / "fact"), str(tmp_path / "new")
    write_table(items(spark, ("1", d(2024, 1, 5), "a", m(1)), ("2", d(2024, 2, 5), "a", m(2)), (None, d(2024, 2, 6), "a", m(5))), path, ["year", "month"])
    write_table(items(spark, ("1", d(2024, 1, 6), "a", m(10)), ("3", d(2024, 2, 7), "b", m(3)), (None, None, "b", m(4))), source, ["year", "month"])
    new = spark.read.schema(schemas.FACT_ORDERS).parquet(source)
    for stored in (True, False):
        upsert_orders(spark, path, new.where("order_id is not null or not " + str(stored).lower()), stored=stored)
        plan = written[-1][0]._jdf.queryExecution().optimizedPlan().toString()
        assert written[-1][1] == stored and ("Join" in plan) == (not stored)
    # The second time February keeps orders and loses one; nothing but new items was copied.
    assert copies == ["new-items"]
    assert rows(spark.read.parquet(path), "order_id", "revenue", "month") == [
        ("1", m("10.00"), 1), ("2", m("2.00"), 2), ("3", m("3.00"), 2), (None, m("4.00"), None), (None, m("5.00"), 2),
    ]
