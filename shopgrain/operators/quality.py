"""Declarative data-quality rules, all evaluated in one pass over a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, VariantType

from ..functions import to_number
from ..schemas import struct

RESULT = struct(
    check_name="string",
    check_type="string",
    column="string",
    passed="boolean",
    null_count="long",
    total_count="long",
    null_percentage="double",
    threshold="integer",
    total_values="long",
    unique_values="long",
    duplicate_count="long",
    min_value="double",
    max_value="double",
    out_of_range_count="long",
    row_count="long",
    min_rows="long",
    max_rows="long",
    valid_values=ArrayType(StringType()),
    invalid_count="long",
    error="string",
)


def _columns(df: DataFrame) -> dict[str, DataType]:
    return {f.name: f.dataType for f in df.schema}


@dataclass(frozen=True)
class NotNull:
    """No nulls. A column the table lacks counts as null in every row."""

    column: str
    check_type = "not_null"

    def measures(self, df: DataFrame) -> dict[str, Column]:
        known = self.column in _columns(df)
        nulls = F.count_if(F.col(self.column).isNull()) if known else F.count("*")
        return {"nulls": nulls, "rows": F.count("*")}

    def outcome(self, get: Callable[[str], Column]) -> dict[str, Column]:
        nulls, rows = get("nulls"), get("rows")
        share = F.when(rows > 0, F.bround(nulls / rows * 100, 2)).otherwise(0.0)
        return {
            "passed": nulls == 0,
            "null_count": nulls,
            "total_count": rows,
            "null_percentage": share,
            "threshold": F.lit(0),
        }


@dataclass(frozen=True)
class Unique:
    """No value twice. Nulls are not looked at."""

    column: str
    check_type = "unique"

    def measures(self, df: DataFrame) -> dict[str, Column]:
        data_type = _columns(df).get(self.column)
        if data_type is None:
            none = F.lit(0).cast("bigint")
            return {"values": F.max(none), "distinct": F.max(none)}
        if isinstance(data_type, (MapType, VariantType)):
            raise TypeError(f"values of type {data_type.simpleString()} cannot be compared")
        return {"values": F.count(self.column), "distinct": F.count_distinct(self.column)}

    def outcome(self, get: Callable[[str], Column]) -> dict[str, Column]:
        values, distinct = F.coalesce(get("values"), F.lit(0)), F.coalesce(get("distinct"), F.lit(0))
        return {
            "passed": values == distinct,
            "total_values": values,
            "unique_values": distinct,
            "duplicate_count": values - distinct,
        }


@dataclass(frozen=True)
class Range:
    """Numbers within inclusive bounds, each of them optional.

    Values that are not numbers are passed over, though they stay in the total;
    NaN is never out of range. A column with no values at all passes and leaves
    no result.
    """

    column: str
    min_value: float | None = None
    max_value: float | None = None
    check_type = "range"

    def measures(self, df: DataFrame) -> dict[str, Column]:
        data_type = _columns(df).get(self.column)
        if data_type is None:
            return {"values": F.count(F.lit(None)), "outside": F.count(F.lit(None))}
        number = to_number(F.col(self.column), data_type)
        outside = F.lit(False)
        if self.min_value is not None:
            outside = outside | (number < float(self.min_value))
        if self.max_value is not None:
            outside = outside | (number > float(self.max_value))
        return {
            "values": F.count(self.column),
            "outside": F.count_if(~F.isnan(number) & outside),
        }

    def outcome(self, get: Callable[[str], Column]) -> dict[str, Column]:
        outside = get("outside")
        return {
            "recorded": get("values") > 0,
            "passed": outside == 0,
            "min_value": F.lit(self.min_value),
            "max_value": F.lit(self.max_value),
            "out_of_range_count": outside,
            "total_count": get("values"),
        }


@dataclass(frozen=True)
class RowCount:
    """Number of rows within inclusive bounds."""

    min_rows: int = 0
    max_rows: int | None = None
    column = None
    check_type = "row_count"

    def measures(self, df: DataFrame) -> dict[str, Column]:
        return {"rows": F.count("*")}

    def outcome(self, get: Callable[[str], Column]) -> dict[str, Column]:
        rows = get("rows")
        passed = rows >= self.min_rows
        if self.max_rows is not None:
            passed = passed & (rows <= self.max_rows)
        return {
            "passed": passed,
            "row_count": rows,
            "min_rows": F.lit(self.min_rows),
            "max_rows": F.lit(self.max_rows),
        }


@dataclass(frozen=True)
class ValueSet:
    """Only allowed values, compared with upper and lower case kept apart."""

    column: str
    valid_values: tuple[str, ...]
    check_type = "value_set"

    def measures(self, df: DataFrame) -> dict[str, Column]:
        if self.column not in _columns(df):
            return {"values": F.count(F.lit(None)), "invalid": F.count(F.lit(None))}
        return {
            "values": F.count(self.column),
            "invalid": F.count_if(~F.col(self.column).isin(list(self.valid_values))),
        }

    def outcome(self, get: Callable[[str], Column]) -> dict[str, Column]:
        return {
            "passed": get("invalid") == 0,
            "valid_values": F.array(*[F.lit(v) for v in sorted(self.valid_values)]),
            "invalid_count": get("invalid"),
            "total_count": get("values"),
        }


Rule = NotNull | Unique | Range | RowCount | ValueSet


def check(
    df: DataFrame, table_name: str, rules: Sequence[Rule], skip_empty: bool = False
) -> DataFrame:
    """One result row per rule, from a single aggregation of the table.

    A rule that cannot be applied to the table gives a failed result with the
    reason in ``error``. ``skip_empty`` gives no results for a table without
    rows, as if it had not been checked.
    """
    measures: list[Column] = [F.count("*").alias("all_rows")]
    results: list[Column] = []
    for number, rule in enumerate(rules):
        place = f".{rule.column}" if rule.column else ""
        values = {"check_name": F.lit(f"{table_name}{place}.{rule.check_type}")}
        recorded = F.lit(True)
        try:
            wanted = rule.measures(df)
            # Analysed here, so that one misfit does not take the others down.
            df.select(*wanted.values())
            measures += [m.alias(f"m{number}_{key}") for key, m in wanted.items()]
            outcome = rule.outcome(lambda key, n=number: F.col(f"m{n}_{key}"))
            recorded = outcome.pop("recorded", recorded)
            values |= outcome
            values |= {"check_type": F.lit(rule.check_type), "column": F.lit(rule.column)}
        except Exception as error:  # noqa: BLE001 - any failure is a failed check
            values |= {"passed": F.lit(False), "error": F.lit(str(error))}
        row = F.struct(
            *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RESULT]
        )
        results.append(F.when(recorded, row))
    measured = df.agg(*measures)
    if skip_empty:
        measured = measured.filter(F.col("all_rows") > 0)
    return (
        measured.select(F.explode(F.array_compact(F.array(*results))).alias("result"))
        .select(F.lit(table_name).alias("table_name"), "result.*")
    )


def _summary_columns() -> list[Column]:
    total, passed = F.count("*"), F.count_if("passed")
    return [
        total.alias("total_checks"),
        passed.alias("checks_passed"),
        (total - passed).alias("checks_failed"),
        F.bround(passed / total * 100, 2).alias("success_rate"),
        (total == passed).alias("all_passed"),
    ]


def summarize(results: DataFrame) -> DataFrame:
    """Checks passed and failed per table."""
    return results.groupBy("table_name").agg(*_summary_columns())


def result_records(results: DataFrame, run_id: str, timestamp: dt.datetime | str) -> DataFrame:
    """The rows kept of a run: each table's summary and its results as JSON.

    A table has as many results as it has rules, so the array is small.
    """
    fields = [c for c in results.columns if c != "table_name"]
    texts = F.to_json(F.array_sort(F.collect_list(F.struct(*fields)))).alias("results")
    stored = results.groupBy("table_name").agg(*_summary_columns(), texts)
    return stored.select(
        F.concat_ws("_", "table_name", F.lit(run_id)).alias("check_id"),
        F.lit(timestamp).cast("timestamp").alias("timestamp"),
        "table_name",
        F.lit(run_id).alias("run_id"),
        *stored.columns[1:],
    )


def alert_report(summaries: DataFrame) -> DataFrame:
    """One message per table with failed checks; no rows when all passed."""
    text = F.format_string(
        "Table: %s\n  Checks Failed: %d/%d\n  Success Rate: %s%%",
        "table_name",
        "checks_failed",
        "total_checks",
        F.col("success_rate").cast("string"),
    )
    return summaries.filter(~F.col("all_passed")).select("table_name", text.alias("message"))


def verdict(summaries: DataFrame, run_id: str, day: dt.date | str) -> DataFrame:
    """One row for the whole run; a run that checked nothing has passed."""
    return summaries.agg(
        F.lit(run_id).alias("run_id"),
        F.lit(day).cast("date").alias("date"),
        F.coalesce(F.bool_and("all_passed"), F.lit(True)).alias("all_passed"),
        F.count("*").alias("tables_checked"),
        F.count_if(~F.col("all_passed")).alias("tables_failed"),
    )
