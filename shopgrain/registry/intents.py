"""Queries over row history, trends, retention and typed events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import scratch
from ..operators import assign_keys, valid_on
from ..plans import behaviour, gold, silver
from ..plans.lakehouse import Lakehouse
from ..sources import warehouse
from .common import AS_OF, ITEMS_CTE, LOAD_TIME, cents, half_up, lake, plain
from .gold import COHORT_CTE


def scd2(spark, folder):
    """Both dimensions of a lakehouse that keeps history, loaded twice and then again.

    The second load, thirty days later, has dearer small parts, lacks the parts of one
    brand, and knows new names for customers in debt."""
    house = Lakehouse(spark, scratch.new_path(spark, "history"))
    products, people = warehouse.products(spark, folder), warehouse.customers(spark, folder)
    dear = F.when(F.col("rating.count") < 150, (F.col("price").cast("decimal(10,2)") + 1).cast("string"))
    debtors = warehouse.table(spark, folder, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("id"), F.lit("Doe").alias("_name")
    )
    name = F.when(F.col("_name").isNotNull(), F.col("name").withField("lastname", F.col("_name")))
    first = {"products": products.filter("description <> 'Brand#2'"), "customers": people}
    later = {
        "products": products.filter("description <> 'Brand#3'").withColumn("price", F.coalesce(dear, "price")),
        "customers": people.join(debtors, "id", "left").withColumn("name", F.coalesce(name, "name")).drop("_name"),
    }
    house.build_dimensions(first, f"{AS_OF} 00:00:00", history=True)
    for _ in range(2):
        house.build_dimensions(later, f"{AS_OF + dt.timedelta(days=30)} 00:00:00", history=True)
    stamps = ["effective_date", "expiration_date", "is_current"]
    goods = house.table("dim_products").select(
        F.lit("product").alias("dimension"), F.col("product_id").alias("id"), "product_key",
        F.col("price").cast("string").alias("value"), *stamps,
    )
    names = house.table("dim_customers").select(
        F.lit("customer"), "customer_id", "customer_key", "last_name", *stamps
    )
    both = goods.unionAll(names)
    # How many versions share a key: one, everywhere.
    return both.withColumn(
        "same_key", F.count("*").over(Window.partitionBy("dimension", "product_key"))
    ).drop("product_key")


_SCD2_SQL = f"""
with p as (
  select p_partkey::varchar as id, p_retailprice::decimal(10,2) as price,
         p_size < 15 as dearer, p_brand <> 'Brand#2' as was, p_brand <> 'Brand#3' as stays
  from part
), days as (select date '{AS_OF}' as first_day, (date '{AS_OF}' + 30)::date as next_day,
                   date '2099-12-31' as open_end)
select 'product' as dimension, id, price::varchar as value, first_day as effective_date,
       case when stays and dearer then next_day else open_end end as expiration_date,
       not (stays and dearer) as is_current, 1::bigint as same_key
from p, days where was
union all
select 'product', id, (price + dearer::int)::decimal(10,2)::varchar, next_day, open_end, true, 1
from p, days where stays and (not was or dearer)
union all
select 'customer', c_custkey::varchar, split_part(c_name, '#', 2), first_day,
       case when c_acctbal < 0 then next_day else open_end end, c_acctbal >= 0, 1
from customer, days
union all
select 'customer', c_custkey::varchar, 'Doe', next_day, open_end, true, 1
from customer, days where c_acctbal < 0
"""


def growth(spark, folder):
    fact = lake(spark, folder).table("fact_orders")
    return plain(gold.category_growth(gold.category_analysis(fact, LOAD_TIME)))


_GROWTH_SQL = f"""
with {ITEMS_CTE},
c as (select category, year, month, sum(revenue) as r from fact group by all),
g as (select *, lag(r) over (partition by category order by year, month) as p from c)
select category, year, month, r::double as total_revenue, p::double as previous_revenue,
       (r - p)::double as revenue_change,
       {half_up("100 * " + cents("r - p"), cents("p"), 2)} as growth_percent
from g
"""


def product_growth(spark, folder):
    return plain(gold.product_growth(lake(spark, folder).table("fact_orders")))


def product_mix(spark, folder):
    return plain(gold.product_mix(lake(spark, folder).table("fact_orders")))


_PRODUCT_GROWTH_SQL = f"""
with {ITEMS_CTE},
c as (select product_id, category, year, month, sum(revenue) as r from fact group by all),
g as (select *, lag(r) over (partition by product_id, category order by year, month) as p from c)
select product_id, category, year, month, r::double as total_revenue,
       p::double as previous_revenue, (r - p)::double as revenue_change,
       {half_up("100 * " + cents("r - p"), cents("p"), 2)} as growth_percent
from g
"""

_PRODUCT_MIX_SQL = f"""
with {ITEMS_CTE},
c as (select product_id, category, year, month, sum(revenue) as r, sum(quantity)::bigint as q
      from fact group by all),
m as (select *, sum(r) over (partition by category, year, month) as w from c)
select product_id, category, year, month, r::double as total_revenue, q as total_quantity,
       w::double as category_revenue, {half_up("100 * " + cents("r"), cents("w"), 2)} as revenue_share
from m
"""


def event_counts(spark, folder):
    """Counts from the stored events."""
    counts = silver.event_counts(lake(spark, folder).table("events"))
    return counts.select(
        "customer_id", "event_type", "events",
        F.unix_micros("first_time").alias("first_micros"), F.unix_micros("last_time").alias("last_micros"),
    )


def retention(spark, folder):
    fact = lake(spark, folder).table("fact_orders")
    return plain(gold.cohort_retention(gold.cohort_analysis(fact, LOAD_TIME)))


_RETENTION_SQL = f"""
with {COHORT_CTE},
s as (
  select *, first_value(active_customers) over (
    partition by cohort_year, cohort_month order by months_since_first_purchase) as cohort_size
  from cohorts
)
select cohort_year, cohort_month, months_since_first_purchase, active_customers, cohort_size,
       {half_up("100 * active_customers", "cohort_size", 2)} as retention_percent
from s
"""


def rollup(spark, folder):
    return plain(gold.daily_category_rollup(lake(spark, folder).table("fact_orders")))


def lifetime_value(spark, folder):
    house = lake(spark, folder)
    filled = gold.with_lifetime_value(house.table("dim_customers"), house.table("fact_orders"))
    return plain(filled.select("customer_id", "segment", "lifetime_value"))


def typed_events(spark, folder):
    return lake(spark, folder).table("events").select(
        "event_id",
        "event_type",
        F.unix_micros("event_time").alias("micros"),
        "event_date",
        "customer_id",
        "device",
    )


FUNNEL = ("view", "click", "purchase")
# Test events of a customer are hours apart.
_GAP = 600


def sessions(spark, folder):
    found = behaviour.event_sessions(lake(spark, folder).table("events"), _GAP)
    return found.select(
        "customer_id", F.unix_micros("start").alias("first_micros"), F.unix_micros("end").alias("last_micros"),
        "events", "kinds", "device", "seconds",
    )


_SESSIONS_CTE = f"""
known as (select *, user_id::varchar as customer_id from events where user_id is not null and ts is not null),
gaps as (select *, epoch_us(ts) - epoch_us(lag(ts) over (partition by customer_id order by ts)) as gap from known),
tagged as (select *, sum((gap is null or gap > {_GAP * 60_000_000})::int) over (
             partition by customer_id order by ts rows unbounded preceding) as session from gaps)
"""

_SESSIONS_SQL = f"""
with {_SESSIONS_CTE}
select customer_id, min(epoch_us(ts)) as first_micros, max(epoch_us(ts)) as last_micros, count(*) as events,
       count(distinct event_type) as kinds,
       max(list_extract(['desktop', 'mobile', 'tablet'], (props->>'$.k')::int % 3 + 1)) as device,
       (max(epoch_us(ts)) - min(epoch_us(ts))) / 1000000 as seconds
from tagged group by customer_id, session
"""


def funnel(spark, folder):
    """Steps passed by each session, and what that makes over all."""
    passed = behaviour.event_funnel(lake(spark, folder).table("events"), FUNNEL, _GAP)
    passed = scratch.materialize(passed, "funnel")
    each = passed.select(
        F.lit("session").alias("kind"), F.concat_ws("@", "customer_id", F.unix_micros("session")).alias("id"),
        "steps_passed", F.lit(None).cast("long").alias("passed"),
    )
    counts = behaviour.funnel_counts(passed, FUNNEL)
    return each.unionAll(counts.select(F.lit("step"), "name", "step", "passed"))


_FUNNEL_SQL = f"""
with {_SESSIONS_CTE},
viewed as (select customer_id, session, min(epoch_us(ts)) as started,
                  min(ts) filter (event_type = 'view') as v from tagged group by all),
clicked as (select f.*, (select min(ts) from tagged t where t.customer_id = f.customer_id and t.session = f.session
                         and event_type = 'click' and ts > v) as c from viewed f),
bought as (select f.*, (select min(ts) from tagged t where t.customer_id = f.customer_id and t.session = f.session
                        and event_type = 'purchase' and ts > c) as p from clicked f),
passed as (select customer_id, started, case when p is not null then 3 when c is not null then 2
                  when v is not null then 1 else 0 end as steps_passed from bought)
select 'session' as kind, customer_id || '@' || started as id, steps_passed, null::bigint as passed from passed
union all
select 'step', ['session', 'view', 'click', 'purchase'][step + 1], step::int, count(*) filter (steps_passed >= step)
from passed, (select unnest([0, 1, 2, 3]) as step) group by step
"""


def fact_valid_at(spark, folder):
    """Items with the price and name of the part on the day of their order: parts were
    loaded at the end of 1996, and changed at the end of 1998 and of 1999."""
    house = Lakehouse(spark, scratch.new_path(spark, "versions"))
    products = warehouse.products(spark, folder)
    price = F.col("price").cast("decimal(10,2)")
    size = F.col("rating.count")
    dear = products.withColumn("price", F.when(size < 150, price + 1).otherwise(price).cast("string"))
    new = dear.withColumn("title", F.when(size >= 300, F.concat("title", F.lit(" II"))).otherwise(F.col("title")))
    for day, documents in (("1996-12-31", products), ("1998-12-31", dear), ("1999-12-31", new)):
        house.build_dimension("products", documents, f"{day} 00:00:00", history=True)
    fact = lake(spark, folder).table("fact_orders").select("order_id", "product_id", "quantity", "order_date")
    valid = valid_on(fact, house.table("dim_products"), "product_id", "order_date", "product_name", "price", "effective_date")
    return plain(valid)


_VALID_SQL = f"""
with {ITEMS_CTE}
select order_id, product_id, quantity, order_date,
       case when p_size >= 30 and order_date >= date '1999-12-31' then p_name || ' II' else p_name end as product_name,
       (p_retailprice::decimal(10,2) + (p_size < 15 and order_date >= date '1998-12-31')::int)::double as price,
       case when p_size < 15 and order_date >= date '1998-12-31' then date '1998-12-31'
            when p_size >= 30 and order_date >= date '1999-12-31' then date '1999-12-31'
            else date '1996-12-31' end as effective_date
from items join part on p_partkey::varchar = product_id
"""


def key_numbers(spark, folder):
    """Numbers of products: all but one brand first, then all, twice."""
    path = scratch.new_path(spark, "keys")
    parts = warehouse.table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("product_id"), "p_brand")
    assign_keys(spark, path, parts.filter("p_brand <> 'Brand#2'").select("product_id"))
    assign_keys(spark, path, parts.select("product_id"))
    return assign_keys(spark, path, parts.select("product_id").unionAll(parts.select("product_id")))


QUERIES = {
    "event_sessions": (sessions, _SESSIONS_SQL),
    "event_funnel": (funnel, _FUNNEL_SQL),
    "fact_valid_at": (fact_valid_at, _VALID_SQL),
    "key_numbers": (
        key_numbers,
        """select p_partkey::varchar as product_id,
                  row_number() over (order by p_brand = 'Brand#2', p_partkey::varchar) as number
           from part""",
    ),
    "scd2_merge": (scd2, _SCD2_SQL),
    "category_growth": (growth, _GROWTH_SQL),
    "product_growth": (product_growth, _PRODUCT_GROWTH_SQL),
    "product_mix": (product_mix, _PRODUCT_MIX_SQL),
    "event_counts": (
        event_counts,
        """select user_id::varchar as customer_id, event_type, count(*) as events,
                  min(epoch_us(ts)) as first_micros, max(epoch_us(ts)) as last_micros
           from events group by all""",
    ),
    "cohort_retention": (retention, _RETENTION_SQL),
    "daily_category_rollup": (
        rollup,
        f"""with {ITEMS_CTE}
        select order_date, category, grouping(order_date, category)::int as level,
               sum(revenue)::double as total_revenue, sum(quantity)::bigint as total_quantity,
               count(*) as total_items
        from fact group by rollup (order_date, category)""",
    ),
    "customer_ltv_backfill": (
        lifetime_value,
        f"""with {ITEMS_CTE}
        select c_custkey::varchar as customer_id,
               case when c_custkey % 10 = 0 then 'VIP' when c_custkey % 5 = 0 then 'ACTIVE'
                    else 'NEW' end as segment,
               coalesce(sum(revenue), 0)::double as lifetime_value
        from customer left join fact on customer_id = c_custkey::varchar group by c_custkey""",
    ),
    "silver_events": (
        typed_events,
        """select event_id::varchar as event_id, event_type, epoch_us(ts) as micros,
                  ts::date as event_date, user_id::varchar as customer_id,
                  list_extract(['desktop', 'mobile', 'tablet'], (props->>'$.k')::int % 3 + 1)
                    as device
           from events""",
    ),
}
