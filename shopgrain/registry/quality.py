"""Queries over the data-quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import scratch
from ..operators import (
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
from ..operators.quality import RESULT, result_records
from ..plans import suites
from ..sinks import write_bronze_json
from ..sources import warehouse

# The part types of the test tables, in place of the shop's categories.
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
RUN_ID = "run00001"
RUN_DAY = "2001-08-02"
RUN_TIME = "2001-08-02 00:00:00"


def _shown(results):
    return results.select(
        *[
            F.array_join(c, ",").alias(c) if c == "valid_values" else F.col(c)
            for c in results.columns
        ]
    )


def _own_columns(results, *names):
    return _shown(results).select("check_name", "check_type", "column", "passed", *names)


def not_null(spark, folder):
    """Customer names beside the orders, one market segment being unknown."""
    people = warehouse.table(spark, folder, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    joined = warehouse.table(spark, folder, "orders").join(
        people, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    rules = [NotNull("c_name"), NotNull("o_orderkey"), NotNull("absent")]
    return _own_columns(
        check(joined, "orders", rules), "null_count", "total_count", "null_percentage", "threshold"
    )


_NOT_NULL_SQL = """
with j as (
  select o_orderkey, c_name from orders
  left join (select * from customer where c_mktsegment <> 'BUILDING') on c_custkey = o_custkey
), c as (
  select 'c_name' as "column", count(*) - count(c_name) as null_count, count(*) as total_count from j
  union all select 'o_orderkey', count(*) - count(o_orderkey), count(*) from j
  union all select 'absent', count(*), count(*) from j
)
select 'orders.' || "column" || '.not_null' as check_name, 'not_null' as check_type, "column",
       null_count = 0 as passed, null_count, total_count,
       round_even(null_count / total_count * 100, 2) as null_percentage, 0 as threshold
from c
"""


def unique(spark, folder):
    results = check(
        warehouse.table(spark, folder, "lineitem"), "lineitem", [Unique("l_orderkey")]
    ).unionAll(
        check(
            warehouse.table(spark, folder, "orders"),
            "orders",
            [Unique("o_orderkey"), Unique("absent")],
        )
    )
    return _own_columns(results, "total_values", "unique_values", "duplicate_count")


_UNIQUE_SQL = """
with c as (
  select 'lineitem' as t, 'l_orderkey' as "column", count(l_orderkey) as total_values,
         count(distinct l_orderkey) as unique_values from lineitem
  union all select 'orders', 'o_orderkey', count(o_orderkey), count(distinct o_orderkey) from orders
  union all select 'orders', 'absent', 0, 0
)
select t || '.' || "column" || '.unique' as check_name, 'unique' as check_type, "column",
       total_values = unique_values as passed, total_values, unique_values,
       total_values - unique_values as duplicate_count
from c
"""


def value_range(spark, folder):
    rules = [Range("c_acctbal", 0, 5000), Range("c_acctbal", max_value=1e9), Range("c_name", 0)]
    return _own_columns(
        check(warehouse.table(spark, folder, "customer"), "customer", rules),
        "min_value", "max_value", "out_of_range_count", "total_count",
    )


_RANGE_SQL = """
with c as (
  select 'c_acctbal' as "column", 0::double as min_value, 5000::double as max_value,
         count(*) filter (c_acctbal < 0 or c_acctbal > 5000) as out_of_range_count,
         count(c_acctbal) as total_count from customer
  union all select 'c_acctbal', null, 1e9, count(*) filter (c_acctbal > 1e9), count(c_acctbal)
    from customer
  union all select 'c_name', 0, null, 0, count(c_name) from customer
)
select 'customer.' || "column" || '.range' as check_name, 'range' as check_type, "column",
       out_of_range_count = 0 as passed, min_value, max_value, out_of_range_count, total_count
from c
"""


def row_count(spark, folder):
    rules = [RowCount(1, 1000), RowCount(1)]
    return _own_columns(
        check(warehouse.table(spark, folder, "part"), "part", rules),
        "row_count", "min_rows", "max_rows",
    )


_ROW_COUNT_SQL = """
with c as (select count(*) as row_count from part), m as (
  select 1000::bigint as max_rows union all select null)
select 'part.row_count' as check_name, 'row_count' as check_type, null::varchar as "column",
       row_count >= 1 and row_count <= coalesce(max_rows, row_count) as passed,
       row_count, 1::bigint as min_rows, max_rows
from c, m
"""


def value_set(spark, folder):
    rules = [ValueSet("p_type", TYPES[:-1]), ValueSet("p_type", TYPES)]
    return _own_columns(
        check(warehouse.table(spark, folder, "part"), "part", rules),
        "valid_values", "invalid_count", "total_count",
    )


_VALUE_SET_SQL = f"""
with s as (
  select '{",".join(TYPES[:-1])}' as valid_values union all select '{",".join(TYPES)}'
), c as (
  select valid_values,
         count(*) filter (not list_contains(string_split(valid_values, ','), p_type))
           as invalid_count,
         count(p_type) as total_count
  from part, s group by valid_values
)
select 'part.p_type.value_set' as check_name, 'value_set' as check_type, 'p_type' as "column",
       invalid_count = 0 as passed, valid_values, invalid_count, total_count
from c
"""


def _products(spark, folder):
    return check(
        warehouse.products(spark, folder), "products", suites.products_suite(TYPES), skip_empty=True
    )


def _customers(spark, folder):
    return check(
        warehouse.customers(spark, folder), "customers", suites.customers_suite(), skip_empty=True
    )


def _orders(spark, folder):
    return check(
        warehouse.orders(spark, folder), "orders", suites.orders_suite(), skip_empty=True
    )


def _all_results(spark, folder):
    return (
        _products(spark, folder)
        .unionAll(_customers(spark, folder))
        .unionAll(_orders(spark, folder))
    )


# One SQL row per rule, with the columns of every rule type.
_RESULT_TYPES = {
    "check_name": "varchar", "check_type": "varchar", "column": "varchar", "passed": "boolean",
    "null_count": "bigint", "total_count": "bigint", "null_percentage": "double",
    "threshold": "int", "total_values": "bigint", "unique_values": "bigint",
    "duplicate_count": "bigint", "min_value": "double", "max_value": "double",
    "out_of_range_count": "bigint", "row_count": "bigint", "min_rows": "bigint",
    "max_rows": "bigint", "valid_values": "varchar", "invalid_count": "bigint", "error": "varchar",
}
assert list(_RESULT_TYPES) == RESULT.names


def _result_sql(table: str, source: str, **values: str) -> str:
    columns = [f"'{table}' as table_name"] + [
        f'({values.get(name, "null")})::{kind} as "{name}"' for name, kind in _RESULT_TYPES.items()
    ]
    return f"select {', '.join(columns)} from {source}"


def _not_null_row(table: str, source: str, column: str, value: str) -> str:
    nulls = f"(count(*) - count({value}))"
    return _result_sql(
        table, source, check_name=f"'{table}.{column}.not_null'", check_type="'not_null'",
        column=f"'{column}'", passed=f"{nulls} = 0", null_count=nulls, total_count="count(*)",
        null_percentage=f"round_even({nulls} / count(*) * 100, 2)", threshold="0",
    )


def _unique_row(table: str, source: str, column: str, value: str) -> str:
    n, d = f"count({value})", f"count(distinct {value})"
    return _result_sql(
        table, source, check_name=f"'{table}.{column}.unique'", check_type="'unique'",
        column=f"'{column}'", passed=f"{n} = {d}", total_values=n, unique_values=d,
        duplicate_count=f"{n} - {d}",
    )


def _row_count_row(table: str, source: str, most: str) -> str:
    return _result_sql(
        table, source, check_name=f"'{table}.row_count'", check_type="'row_count'",
        passed=f"count(*) >= 1 and count(*) <= coalesce({most}, count(*))",
        row_count="count(*)", min_rows="1", max_rows=most,
    )


_OUTSIDE = "count(*) filter (p_retailprice < 0 or p_retailprice > 10000)"
_VALID = ", ".join(f"'{t}'" for t in TYPES)
_INVALID = f"count(*) filter (p_type not in ({_VALID}))"

_PRODUCTS_SQL = " union all ".join(
    [
        _not_null_row("products", "part", "id", "p_partkey"),
        _not_null_row("products", "part", "title", "p_name"),
        _not_null_row("products", "part", "price", "p_retailprice"),
        _unique_row("products", "part", "id", "p_partkey"),
        _result_sql(
            "products", "part", check_name="'products.price.range'", check_type="'range'",
            column="'price'", passed=f"{_OUTSIDE} = 0", min_value="0", max_value="10000",
            out_of_range_count=_OUTSIDE, total_count="count(p_retailprice)",
        ),
        _row_count_row("products", "part", "1000"),
        _result_sql(
            "products", "part", check_name="'products.category.value_set'",
            check_type="'value_set'", column="'category'", passed=f"{_INVALID} = 0",
            valid_values=f"'{','.join(TYPES)}'", invalid_count=_INVALID,
            total_count="count(p_type)",
        ),
    ]
)

_CUSTOMERS_SQL = " union all ".join(
    [
        _not_null_row("customers", "customer", "id", "c_custkey"),
        _not_null_row("customers", "customer", "email", "c_name"),
        _unique_row("customers", "customer", "id", "c_custkey"),
        _unique_row("customers", "customer", "email", "lower(c_name)"),
        _row_count_row("customers", "customer", "10000"),
    ]
)

_ORDERS_SQL = " union all ".join(
    [
        _not_null_row("orders", "orders", "id", "o_orderkey"),
        _not_null_row("orders", "orders", "userId", "o_custkey"),
        _not_null_row("orders", "orders", "date", "o_orderdate"),
        _unique_row("orders", "orders", "id", "o_orderkey"),
        _row_count_row("orders", "orders", "null"),
    ]
)

_SUMMARY_CTE = f"""
results as ({_PRODUCTS_SQL} union all {_CUSTOMERS_SQL} union all {_ORDERS_SQL}),
summary as (
  select table_name, count(*) as total_checks, count(*) filter (passed) as checks_passed,
         count(*) filter (not passed) as checks_failed,
         round_even(count(*) filter (passed) / count(*) * 100, 2) as success_rate,
         bool_and(passed) as all_passed
  from results group by table_name
)
"""


def summary(spark, folder):
    return summarize(_all_results(spark, folder))


def results_table(spark, folder):
    """Store a run's results, read them back and unpack the JSON."""
    path = scratch.new_path(spark, "dq-results")
    records = result_records(_all_results(spark, folder), RUN_ID, RUN_TIME)
    records.write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    kinds = "array<struct<check_name: string, check_type: string, column: string, passed: boolean>>"
    return stored.select(
        "check_id", "table_name", "run_id", "total_checks", "checks_passed", "checks_failed",
        "success_rate", "all_passed", F.explode(F.from_json("results", kinds)).alias("result"),
    ).select("*", "result.*").drop("result")


def alerts(spark, folder):
    return alert_report(summary(spark, folder))


def verdicts(spark, folder):
    """The verdict over all tables, and over a run that found no data."""
    summaries = summary(spark, folder)
    nothing = summaries.filter(F.lit(False))
    return verdict(summaries, RUN_ID, RUN_DAY).unionAll(verdict(nothing, "empty", RUN_DAY))


def daily_run(spark, folder):
    """A day of bronze files checked in one call, twice under one run id, then another
    day without any: stored results of the run, messages and both verdicts."""
    root, store = scratch.new_path(spark, "dq-bronze"), scratch.new_path(spark, "dq-store")
    day = F.lit(RUN_DAY).cast("date")
    for name in ("products", "customers", "orders"):
        write_bronze_json(warehouse.bronze(spark, folder)[name], f"{root}/{name}", day)
    rules = {
        "products": suites.products_suite(TYPES),
        "customers": suites.customers_suite(),
        "orders": suites.orders_suite(),
    }
    for _ in range(2):
        run = suites.check_day(spark, root, RUN_DAY, RUN_ID, store, RUN_TIME, rules)
    empty = suites.check_day(spark, root, "2001-01-01", "empty", store, RUN_TIME, rules)
    text = F.lit(None).cast("string")
    found = run.records.join(run.alerts, "table_name", "left").select(
        "run_id", "table_name", "total_checks", "checks_failed", "all_passed", "message"
    )
    verdicts = run.verdict.unionAll(empty.verdict).select(
        "run_id", text.alias("table_name"), F.col("tables_checked").alias("total_checks"),
        F.col("tables_failed").alias("checks_failed"), "all_passed", text.alias("message"),
    )
    return found.unionByName(verdicts)


QUERIES = {
    "dq_daily_run": (
        daily_run,
        f"""with {_SUMMARY_CTE}
        select '{RUN_ID}' as run_id, table_name, total_checks, checks_failed, all_passed,
               case when not all_passed then 'Table: ' || table_name || chr(10) || '  Checks Failed: '
                 || checks_failed || '/' || total_checks || chr(10) || '  Success Rate: '
                 || success_rate || '%' end as message
        from summary
        union all select '{RUN_ID}', null, count(*), count(*) filter (not all_passed),
                         bool_and(all_passed), null from summary
        union all select 'empty', null, 0, 0, true, null""",
    ),
    "dq_not_null": (not_null, _NOT_NULL_SQL),
    "dq_unique": (unique, _UNIQUE_SQL),
    "dq_range": (value_range, _RANGE_SQL),
    "dq_row_count": (row_count, _ROW_COUNT_SQL),
    "dq_value_set": (value_set, _VALUE_SET_SQL),
    "dq_suite_products": (lambda s, f: _shown(_products(s, f)), _PRODUCTS_SQL),
    "dq_suite_customers": (lambda s, f: _shown(_customers(s, f)), _CUSTOMERS_SQL),
    "dq_suite_orders": (lambda s, f: _shown(_orders(s, f)), _ORDERS_SQL),
    "dq_summary": (summary, f"with {_SUMMARY_CTE} select * from summary"),
    "dq_results_table": (
        results_table,
        f"""with {_SUMMARY_CTE}
        select table_name || '_{RUN_ID}' as check_id, table_name, '{RUN_ID}' as run_id,
               total_checks, checks_passed, checks_failed, success_rate, all_passed,
               check_name, check_type, "column", passed
        from summary join results using (table_name)""",
    ),
    "dq_alert_report": (
        alerts,
        f"""with {_SUMMARY_CTE}
        select table_name, 'Table: ' || table_name || chr(10) || '  Checks Failed: '
               || checks_failed || '/' || total_checks || chr(10) || '  Success Rate: '
               || success_rate || '%' as message
        from summary where not all_passed""",
    ),
    "dq_verdict": (
        verdicts,
        f"""with {_SUMMARY_CTE}
        select '{RUN_ID}' as run_id, date '{RUN_DAY}' as date, bool_and(all_passed) as all_passed,
               count(*) as tables_checked, count(*) filter (not all_passed) as tables_failed
        from summary
        union all select 'empty', date '{RUN_DAY}', true, 0, 0""",
    ),
}
