from conftest import rows
from pyspark.sql import functions as F

from shopgrain.operators import (
    NotNull,
    Range,
    RowCount,
    Unique,
    ValueSet,
    alert_report,
    check,
    summarize,
    verdict,
)
from shopgrain.operators.quality import RESULT, result_records
from shopgrain.plans import suites


def one(df, rule):
    found = check(df, "t", [rule]).collect()
    return found[0] if found else None


def test_not_null(spark):
    df = spark.range(800).select(F.when(F.col("id") > 0, F.col("id")).alias("v"))
    result = one(df, NotNull("v"))
    # 0.125 % is rounded to the even digit.
    assert (result.check_name, result.passed, result.null_count, result.total_count) == (
        "t.v.not_null", False, 1, 800,
    )
    assert result.null_percentage == 0.12
    assert one(df, NotNull("missing")).null_count == 800
    empty = one(df.filter("false"), NotNull("v"))
    assert (empty.passed, empty.null_percentage) == (True, 0.0)


def test_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "v int")
    result = one(df, Unique("v"))
    assert (result.passed, result.total_values, result.unique_values, result.duplicate_count) == (
        False, 3, 2, 1,
    )
    assert one(df, Unique("missing")).passed


def test_range(spark):
    df = spark.createDataFrame(
        [("0",), ("10",), ("10.5",), ("-1",), ("abc",), ("NaN",), (None,)], "v string"
    )
    result = one(df, Range("v", 0, 10))
    assert (result.passed, result.out_of_range_count, result.total_count) == (False, 2, 6)
    assert one(df, Range("v", min_value=-1)).passed
    numbers = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert one(numbers, Range("v", 0, 5)).passed
    # Nothing to look at: no result at all.
    assert one(df.filter("false"), Range("v", 0, 10)) is None
    assert one(df.filter("v is null"), Range("v", 0, 10)) is None
    assert one(df, Range("missing", 0, 10)) is None


def test_row_count(spark):
    for n, passed in [(0, False), (1, True), (1000, True), (1001, False)]:
        assert one(spark.range(n), RowCount(1, 1000)).passed is passed
    assert one(spark.range(0), RowCount()).passed


def test_value_set(spark):
    df = spark.createDataFrame([("TOYS",), ("toys",), (None,)], "v string")
    result = one(df, ValueSet("v", ("TOYS", "HOME")))
    assert (result.passed, result.invalid_count, result.total_count) == (False, 1, 2)
    assert result.valid_values == ["HOME", "TOYS"]


def test_a_rule_that_cannot_run_fails_alone(spark):
    df = spark.sql("select map('a', 1) as m, 1 as v")
    found = check(df, "t", [Unique("m"), NotNull("v")]).collect()
    assert [r.passed for r in found] == [False, True]
    assert "map" in found[0].error and found[1].error is None
    assert found[0].asDict().keys() == {"table_name", *RESULT.names}


def test_suites_and_reports(spark):
    products = spark.createDataFrame(
        [(1, "Lamp", "9.99", "HOME"), (1, "Ball", "20000", "toys"), (2, None, None, None)],
        "id long, title string, price string, category string",
    )
    customers = spark.createDataFrame([(1, "a@x"), (2, "b@x")], "id long, email string")
    orders = spark.createDataFrame([], "id long, userId long, date string")
    tables = {"products": products, "customers": customers, "orders": orders}
    results = suites.check_tables(tables)
    summary = summarize(results)
    # An empty table has not been checked.
    assert rows(summary) == [
        ("customers", 5, 5, 0, 100.0, True), ("products", 7, 2, 5, 28.57, False),
    ]
    failed = rows(results.filter("not passed"), "check_name")
    assert failed == sorted(
        (f"products.{c}",)
        for c in ["title.not_null", "price.not_null", "id.unique", "price.range", "category.value_set"]
    )
    assert [r.message for r in alert_report(summary).collect()] == [
        "Table: products\n  Checks Failed: 5/7\n  Success Rate: 28.57%"
    ]
    assert rows(verdict(summary, "r", "2024-01-01"), "all_passed", "tables_failed") == [(False, 1)]
    assert rows(verdict(summary.filter("false"), "r", "2024-01-01"), "all_passed") == [(True,)]
    records = result_records(results, "r1", "2024-01-01 00:00:00")
    assert rows(records, "check_id", "checks_failed") == [("customers_r1", 0), ("products_r1", 5)]
    unpacked = records.select(F.explode(F.from_json("results", "array<struct<check_name: string>>")))
    assert unpacked.count() == 12


def test_one_job_reads_the_table_once(spark):
    df = spark.range(100).select(F.col("id"), F.col("id").cast("string").alias("title"))
    plan = check(df, "t", suites.orders_suite())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 100") == 1
