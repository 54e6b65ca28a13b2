"""Queries over the exploratory views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import share_of_total
from ..plans import explore
from ..sources import warehouse


_DEVICE = "list_extract(['desktop', 'mobile', 'tablet'], (props->>'$.k')::int % 3 + 1)"


def kpi_counts(spark, folder):
    return explore.kpis(warehouse.bronze(spark, folder))


def raw(spark, folder):
    """Whole rows of every dataset picked by name, under one set of columns."""
    tables = warehouse.bronze(spark, folder)
    listed = {
        "Products": ("id", "title", "price", "description", "category", "image", "rating.rate", "rating.count"),
        "Customers": ("id", "email", "username", "name.firstname", "name.lastname", "address.city",
                      "address.street", "address.zipcode", "phone"),
        "Orders": ("id", "userId", "date", "status", "size(products)"),
        "Events": ("event_id", "event_type", "timestamp", "user_id", "device"),
    }
    parts = []
    for dataset in explore.DATASETS:
        values = [F.coalesce(F.expr(f"cast({c} as string)"), F.lit("")) for c in listed[dataset]]
        row = F.concat_ws("|", *values)
        parts.append(explore.raw(tables, dataset).select(F.lit(dataset).alias("dataset"), row.alias("row")))
    return reduce(DataFrame.unionAll, parts)


def price_stats(spark, folder):
    stats = explore.price_stats(warehouse.products(spark, folder))
    rounded = [c for c in stats.columns if c not in ("category", "n")]
    return stats.select("category", "n", *[F.round(c, 4).alias(c) for c in rounded])


_STATS_SQL = """
with q as (
  select p_type as category, count(*) as n, min(p_retailprice) as min_price,
         quantile_cont(p_retailprice, 0.25) as q1, quantile_cont(p_retailprice, 0.5) as median,
         quantile_cont(p_retailprice, 0.75) as q3, max(p_retailprice) as max_price
  from part group by p_type
)
select category, n, round(min_price, 4) as min_price, round(q1, 4) as q1,
       round(median, 4) as median, round(q3, 4) as q3, round(max_price, 4) as max_price,
       round(q1 - (q3 - q1) * 1.5, 4) as lower_fence, round(q3 + (q3 - q1) * 1.5, 4) as upper_fence
from q
"""


def price_histogram(spark, folder):
    return explore.price_histogram(warehouse.products(spark, folder), 20, by_category=True)


_HISTOGRAM_SQL = """
with v as (select p_type as category, round(p_retailprice * 100)::bigint as v from part),
b as (select category, min(v) as lo, max(v) as hi from v group by category),
j as (
  select category, lo, hi,
         (case when hi = lo then 1 else least((v - lo) * 20 // (hi - lo) + 1, 20) end)::int as bin
  from v join b using (category)
)
select category, bin, (lo + (hi - lo) * (bin - 1) / 20) / 100 as bin_start,
       (lo + (hi - lo) * bin / 20) / 100 as bin_end, count(*) as count
from j group by category, bin, lo, hi
"""


def share(spark, folder):
    """Shares behind each chart that shows parts of a whole."""
    tables = warehouse.bronze(spark, folder)
    charts = {
        "category": explore.category_counts(tables["products"]),
        "city": explore.city_counts(tables["customers"]),
        "status": explore.status_counts(tables["orders"]),
        "device": explore.device_counts(tables["events"]),
    }
    parts = [
        share_of_total(counts).select(
            F.lit(chart).alias("chart"),
            F.col(counts.columns[0]).alias("value"),
            "count",
            F.round("share", 10).alias("share"),
        )
        for chart, counts in charts.items()
    ]
    return reduce(DataFrame.unionAll, parts)


_SHARE_SQL = f"""
with v as (
  select 'category' as chart, p_type as value from part
  union all select 'city', n_name
    from customer left join nation on n_nationkey = c_nationkey
  union all select 'status', o_orderstatus from orders
  union all select 'device', {_DEVICE} from events
), c as (select chart, value, count(*) as count from v where value is not null group by all)
select chart, value, count,
       round(count / sum(count) over (partition by chart), 10) as share from c
"""


def _counts_sql(value: str, name: str, source: str) -> str:
    return (
        f"select {value} as {name}, count(*) as count from {source} "
        f"where {value} is not null group by all"
    )


QUERIES = {
    "kpi_counts": (
        kpi_counts,
        """select 'products' as table_name, count(*) as row_count from part
           union all select 'customers', count(*) from customer
           union all select 'orders', count(*) from orders
           union all select 'events', count(*) from events""",
    ),
    "explore_raw": (
        raw,
        f"""select 'Products' as dataset, concat_ws('|', p_partkey, p_name, p_retailprice, p_brand, p_type,
                   '/img/' || p_partkey || '.jpg', p_size % 5 + 0.5, p_size * 10) as row from part
           union all select 'Customers', concat_ws('|', c_custkey, lower(c_name) || '@email.com', c_name,
                   split_part(c_name, '#', 1), split_part(c_name, '#', 2), coalesce(n_name, ''),
                   coalesce(c_mktsegment, ''), lpad(c_nationkey::varchar, 5, '0'), c_name)
             from customer left join nation on n_nationkey = c_nationkey
           union all select 'Orders', concat_ws('|', o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d'),
                   o_orderstatus, coalesce(nullif(count(l_orderkey), 0)::varchar, ''))
             from orders left join lineitem on l_orderkey = o_orderkey
             group by o_orderkey, o_custkey, o_orderdate, o_orderstatus
           union all select 'Events', concat_ws('|', event_id, event_type,
                   strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), user_id, {_DEVICE}) from events""",
    ),
    "explore_price_stats": (price_stats, _STATS_SQL),
    "explore_price_histogram": (price_histogram, _HISTOGRAM_SQL),
    "explore_share": (share, _SHARE_SQL),
    "explore_ratings": (
        lambda spark, folder: explore.ratings(warehouse.products(spark, folder)),
        """select p_partkey as id, (p_size * 10)::bigint as count,
                  (p_size % 5 + 0.5)::double as rate from part where p_size is not null""",
    ),
    "explore_customer_list": (
        lambda spark, folder: explore.customer_list(warehouse.customers(spark, folder)),
        """select c_custkey as id, lower(c_name) || '@email.com' as email, c_name as username
           from customer""",
    ),
    "explore_category_counts": (
        lambda spark, folder: explore.category_counts(warehouse.products(spark, folder)),
        _counts_sql("p_type", "category", "part"),
    ),
    "explore_city_counts": (
        lambda spark, folder: explore.city_counts(warehouse.customers(spark, folder)),
        _counts_sql(
            "n_name", "city",
            "customer left join nation on n_nationkey = c_nationkey",
        ),
    ),
    "explore_status_counts": (
        lambda spark, folder: explore.status_counts(warehouse.orders(spark, folder)),
        _counts_sql("o_orderstatus", "status", "orders"),
    ),
    "explore_event_counts": (
        lambda spark, folder: explore.event_counts(warehouse.events(spark, folder)),
        _counts_sql("event_type", "event_type", "events"),
    ),
    "explore_device_counts": (
        lambda spark, folder: explore.device_counts(warehouse.events(spark, folder)),
        _counts_sql(_DEVICE, "device", "events"),
    ),
    "explore_daily_orders": (
        lambda spark, folder: explore.daily_orders(warehouse.orders(spark, folder)),
        _counts_sql("o_orderdate::date", "date", "orders"),
    ),
    "explore_search": (
        lambda spark, folder: explore.search(
            warehouse.table(spark, folder, "part"), "p_name", "ring", F.col("p_size") >= 10
        ),
        "select * from part where p_name like '%ring%' and p_size >= 10",
    ),
    "explore_preview": (
        lambda spark, folder: explore.preview(
            warehouse.table(spark, folder, "part"), "p_partkey", 20
        ),
        "select * from part order by p_partkey limit 20",
    ),
}
