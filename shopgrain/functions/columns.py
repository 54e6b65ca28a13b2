"""Text, number and date expressions shared by the plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType

MONEY = "decimal(10,2)"

# Fixed value: share of revenue booked as cost.
COST_SHARE = "0.6"

# Fixed value: what counts as a number when it arrives as text.
NUMBER_TEXT = (
    r"(?i)^\s*[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+)?\s*$"
    r"|^\s*[+-]?(inf|infinity|nan)\s*$"
)


def clean_text(column: str | Column) -> Column:
    return F.trim(column)


def full_name(first: Column, last: Column) -> Column:
    """First and last name joined by a space; a missing part leaves no gap."""
    return F.concat_ws(" ", first, last)


def digits_only(column: str | Column) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def to_number(column: Column, data_type: DataType) -> Column:
    """Double value of a column of any type, null where it has none."""
    if isinstance(data_type, StringType):
        return F.when(
            column.rlike(NUMBER_TEXT), F.regexp_replace(column, "_", "").try_cast("double")
        )
    if isinstance(data_type, (NumericType, BooleanType)):
        return column.cast("double")
    return F.lit(None).cast("double")


def to_day(column: str | Column) -> Column:
    """Calendar day of a date or timestamp text; null if it is neither."""
    return F.to_date(F.try_to_timestamp(column))


def run_time(as_of: dt.datetime | str | None) -> Column:
    """Load time of a run: one fixed value when given, else the query's start."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient to two decimals; null when the denominator is zero."""
    return F.round(F.try_divide(numerator, denominator), 2)


def percent(part: str | Column, whole: str | Column) -> Column:
    """Part of the whole in percent to two decimals; null when the whole is zero."""
    return F.round(F.try_divide(part, whole) * 100, 2)


def line_metrics(quantity: Column, price: Column) -> tuple[Column, Column, Column]:
    """(revenue, cost, profit) of an order item; null once money overflows."""
    revenue = (quantity * price).try_cast(MONEY)
    cost = (revenue * F.lit(COST_SHARE).cast("decimal(2,1)")).try_cast(MONEY)
    return revenue, cost, (revenue - cost).try_cast(MONEY)


def calendar_columns(day: str) -> list[Column]:
    """Attributes of a calendar day, the week starting on Monday."""
    date = F.col(day)
    key = F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
    return [
        date.alias("date"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.weekofyear(date).alias("week"),
        F.dayofmonth(date).alias("day"),
        (F.weekday(date) + 1).alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        (F.weekday(date) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        key.cast("int").alias("date_key"),
    ]
