"""Queries that apply the column helpers to whole table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    clean_text,
    customer_tier,
    digits_only,
    full_name,
    line_metrics,
    percent,
    ratio,
    threshold_score,
    to_day,
)
from ..operators.history import OPEN_END
from ..plans.silver import default_if_missing, number_or_null
from ..sources import warehouse
from .common import half_up, plain


def strings(spark, folder):
    padded = F.concat(F.lit("  "), "c_name", F.lit(" "))
    return warehouse.table(spark, folder, "customer").select(
        "c_custkey",
        clean_text(padded).alias("trimmed"),
        F.upper(clean_text(padded)).alias("upper_case"),
        F.lower(clean_text(padded)).alias("lower_case"),
        full_name(F.col("c_mktsegment"), F.nullif("c_name", F.lit("Customer#000000000"))).alias(
            "joined"
        ),
        digits_only("c_name").alias("digits"),
    )


def conditional(spark, folder):
    """Defaults for customers whose nation is outside the known ones."""
    known = warehouse.table(spark, folder, "nation").filter("n_regionkey <> 0")
    people = warehouse.table(spark, folder, "customer")
    return people.join(known, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey",
        default_if_missing("n_name", "US").alias("country"),
        default_if_missing("n_regionkey", 0).alias("region"),
        threshold_score(F.col("c_acctbal"), (9000, 5000, 2000, 0)).alias("balance"),
    )


def casts(spark, folder):
    parts = warehouse.table(spark, folder, "part")
    return parts.select(
        "p_partkey",
        number_or_null("p_name", "int").alias("name_as_int"),
        number_or_null(F.col("p_retailprice").cast("string"), "decimal(10,2)")
        .cast("double")
        .alias("price"),
        number_or_null(F.col("p_size").cast("string"), "int").alias("size"),
        F.col("p_partkey").cast("string").alias("key_text"),
        F.lit(OPEN_END).cast("date").alias("expiration"),
    )


def line_measures(spark, folder):
    items = warehouse.table(spark, folder, "lineitem").join(
        warehouse.table(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey")
    )
    price = F.col("p_retailprice").cast("decimal(10,2)")
    revenue, cost, profit = line_metrics(F.col("l_quantity").cast("int"), price)
    return plain(
        items.select(
            "l_orderkey",
            "l_partkey",
            revenue.alias("revenue"),
            cost.alias("cost"),
            profit.alias("profit"),
        )
    )


def ratios(spark, folder):
    """Ratios whose denominator, the discount, is often zero."""
    price, discount = (
        F.col("l_extendedprice").cast("decimal(12,2)"),
        F.col("l_discount").cast("decimal(4,2)"),
    )
    quantity = F.col("l_quantity").cast("bigint")
    return plain(
        warehouse.table(spark, folder, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            ratio(price, quantity).alias("price_per_unit"),
            ratio(price, discount).alias("price_per_discount"),
            percent(discount, price).alias("discount_percent"),
        )
    )


_CENTS = "round(l_extendedprice * 100)::bigint"
_DISCOUNT = "round(l_discount * 100)::bigint"

_RATIOS_SQL = f"""
select l_orderkey, l_linenumber,
       {half_up(_CENTS, "100 * l_quantity::bigint", 2)} as price_per_unit,
       {half_up(_CENTS, _DISCOUNT, 2)} as price_per_discount,
       {half_up("100 * " + _DISCOUNT, _CENTS, 2)} as discount_percent
from lineitem
"""


def tiers(spark, folder):
    return warehouse.table(spark, folder, "customer").select(
        "c_custkey", customer_tier(F.col("c_custkey").cast("string")).alias("segment")
    )


def dates(spark, folder):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    day = to_day(text)
    return warehouse.table(spark, folder, "orders").select(
        "o_orderkey",
        day.alias("order_date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        to_day("o_orderpriority").alias("not_a_date"),
        F.datediff(F.lit("2001-08-02").cast("date"), day).alias("age_days"),
    )


def event_time(spark, folder):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return warehouse.table(spark, folder, "events").select(
        "event_id",
        text.alias("iso"),
        F.unix_micros(F.to_timestamp(text)).alias("micros"),
    )


def json_fields(spark, folder):
    return warehouse.table(spark, folder, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )


QUERIES = {
    "fn_string": (
        strings,
        """select c_custkey, c_name as trimmed, upper(c_name) as upper_case,
                  lower(c_name) as lower_case,
                  concat_ws(' ', c_mktsegment, nullif(c_name, 'Customer#000000000')) as joined,
                  regexp_replace(c_name, '[^0-9]', '', 'g') as digits from customer""",
    ),
    "fn_conditional": (
        conditional,
        """select c_custkey, coalesce(n_name, 'US') as country, coalesce(n_regionkey, 0) as region,
                  (case when c_acctbal >= 9000 then 5 when c_acctbal >= 5000 then 4
                        when c_acctbal >= 2000 then 3 when c_acctbal >= 0 then 2
                        else 1 end)::int as balance
           from customer left join (select * from nation where n_regionkey <> 0)
             on n_nationkey = c_nationkey""",
    ),
    "fn_cast": (
        casts,
        """select p_partkey, try_cast(p_name as int) as name_as_int,
                  p_retailprice::decimal(10,2)::double as price, p_size as size,
                  p_partkey::varchar as key_text, date '2099-12-31' as expiration from part""",
    ),
    "fn_line_metrics": (
        line_measures,
        """with r as (
             select l_orderkey, l_partkey,
                    (l_quantity::int * p_retailprice::decimal(10,2))::decimal(10,2) as revenue
             from lineitem join part on p_partkey = l_partkey)
           select l_orderkey, l_partkey, revenue::double as revenue,
                  (revenue * 0.6)::decimal(10,2)::double as cost,
                  (revenue - (revenue * 0.6)::decimal(10,2))::double as profit from r""",
    ),
    "fn_ratios": (ratios, _RATIOS_SQL),
    "fn_customer_tier": (
        tiers,
        """select c_custkey, case when c_custkey % 10 = 0 then 'VIP'
                                  when c_custkey % 5 = 0 then 'ACTIVE' else 'NEW' end as segment
           from customer""",
    ),
    "fn_date": (
        dates,
        """select o_orderkey, o_orderdate::date as order_date, year(o_orderdate)::int as year,
                  month(o_orderdate)::int as month, day(o_orderdate)::int as day,
                  null::date as not_a_date,
                  (date '2001-08-02' - o_orderdate::date)::int as age_days from orders""",
    ),
    "fn_event_time": (
        event_time,
        """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso, epoch_us(ts) as micros
           from events""",
    ),
    "fn_json": (
        json_fields,
        """select event_id, (props->>'$.k')::int as k, props->>'$.k' as k_text,
                  props->>'$.missing' as missing from events""",
    ),
}
