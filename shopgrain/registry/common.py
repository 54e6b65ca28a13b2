"""Shared by the query modules: the stored silver layer and pieces of SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import scratch
from ..functions import RfmThresholds
from ..plans.lakehouse import Lakehouse
from ..sources import warehouse

# The run's date, and revenue limits that suit the test prices.
AS_OF = dt.date(2001, 8, 2)
LOAD_TIME = "2001-08-02 00:00:00"
CALENDAR = ("1995-01-01", "2001-12-31")
THRESHOLDS = RfmThresholds().with_revenue_factor(1000)

_stored: dict[tuple[str, str], Lakehouse] = {}


def lake(spark: SparkSession, folder: str) -> Lakehouse:
    """Silver tables of a folder, built once per application.

    Gold builders read the stored fact, as they do in production.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stored:
        house = Lakehouse(spark, scratch.new_path(spark, "lake"))
        house.build_silver(warehouse.bronze(spark, folder), LOAD_TIME, CALENDAR, inputs=warehouse.paths(folder))
        _stored[key] = house
    return _stored[key]


def plain(df: DataFrame, *dropped: str) -> DataFrame:
    """Decimals as doubles, without the columns that cannot be compared."""
    kept = [f for f in df.schema if f.name not in dropped]
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in kept
        ]
    )


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """SQL for a quotient of integers, rounded half away from zero, null by zero."""
    n, d = f"({numerator})::hugeint", f"({denominator})::hugeint"
    power = 10**digits
    return (
        f"(case when {d} <> 0 then sign({n}) * "
        f"((2 * abs({n}) * {power} + {d}) // (2 * {d}))::double / {power} end)"
    )


def cents(amount: str) -> str:
    """SQL for a decimal amount as whole hundredths."""
    return f"(({amount}) * 100)::hugeint"


ITEMS_CTE = """
items as (
  select o_orderkey::varchar as order_id, o_orderdate::date as order_date,
         o_custkey::varchar as customer_id, l_partkey::varchar as product_id,
         p_type as category, l_quantity::int as quantity, o_orderstatus as status,
         (l_quantity::int * p_retailprice::decimal(10,2))::decimal(10,2) as revenue
  from orders
  join lineitem on l_orderkey = o_orderkey
  join part on p_partkey = l_partkey
  join customer on c_custkey = o_custkey
),
fact as (
  select *, (revenue * 0.6)::decimal(10,2) as cost,
         (revenue - (revenue * 0.6)::decimal(10,2))::decimal(10,2) as profit,
         year(order_date)::int as year, month(order_date)::int as month,
         day(order_date)::int as day
  from items
)
"""
