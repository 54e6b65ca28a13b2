"""Queries that write the tables in some layout and read them back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import scratch
from ..plans import silver
from ..plans.known_columns import remember_schema
from ..schemas import BRONZE_PRODUCTS, KNOWN_COLUMNS
from ..sinks import (
    export_csv,
    run_summary,
    write_bronze_json,
    write_documents,
    write_events,
    write_table,
)
from ..sources import (
    current_lookup,
    discover,
    discover_all,
    evolve,
    query,
    read_bronze,
    read_day,
    read_documents,
    read_table,
    register,
    warehouse,
)
from ..streaming import read_log
from .cleaning import PRODUCTS_SQL
from .common import AS_OF, ITEMS_CTE, LOAD_TIME, THRESHOLDS, lake, plain


def _on(day):
    return F.lit(day).cast("date").alias("day")


def bronze_products(spark, folder):
    path = scratch.new_path(spark, "bronze-products")
    write_documents(
        warehouse.products(spark, folder).select("*", _on(AS_OF)), path, "day"
    )
    return read_bronze(spark, path, "products").select(
        "id", "title", F.col("price").cast("double").alias("price"), "description", "category",
        "image", "rating.rate", "rating.count", "ingest_date",
    )


_BRONZE_PRODUCTS_SQL = f"""
select p_partkey as id, p_name as title, p_retailprice as price, p_brand as description,
       p_type as category, '/img/' || p_partkey || '.jpg' as image,
       (p_size % 5 + 0.5)::double as rate, (p_size * 10)::bigint as count,
       date '{AS_OF}' as ingest_date
from part
"""


def bronze_customers(spark, folder):
    path = scratch.new_path(spark, "bronze-customers")
    people = warehouse.customers(spark, folder)
    # Documents as they arrive: no country in the address.
    address = F.col("address").dropFields("country")
    write_documents(people.withColumn("address", address).select("*", _on(AS_OF)), path, "day")
    return read_bronze(spark, path, "customers").select(
        "id", "email", "username", "password", "name.firstname", "name.lastname",
        "address.city", "address.street", "address.number", "address.zipcode",
        "address.geolocation.lat", "address.country", "phone", "ingest_date",
    )


_BRONZE_CUSTOMERS_SQL = f"""
select c_custkey as id, lower(c_name) || '@email.com' as email, c_name as username,
       null::varchar as password,
       split_part(c_name, '#', 1) as firstname, split_part(c_name, '#', 2) as lastname,
       n_name as city, c_mktsegment as street, c_nationkey::bigint as number,
       lpad(c_nationkey::varchar, 5, '0') as zipcode, null::varchar as lat,
       null::varchar as country,
       c_name as phone, date '{AS_OF}' as ingest_date
from customer left join nation on n_nationkey = c_nationkey
"""


def _order_documents(spark, folder):
    """Orders with their items, ingested at the end of the month they were made in."""
    return warehouse.orders(spark, folder).withColumn("day", F.last_day(F.to_date("date")))


def bronze_orders(spark, folder):
    """The documents' own date differs from the day of their folder."""
    path = scratch.new_path(spark, "bronze-orders")
    write_documents(_order_documents(spark, folder), path, "day")
    quantity = F.aggregate(
        "products", F.lit(0).cast("bigint"), lambda total, item: total + item["quantity"]
    )
    return (
        read_bronze(spark, path, "orders").select(
            "id", "userId", "date", "status", "ingest_date",
            F.coalesce(F.size("products"), F.lit(0)).cast("bigint").alias("items"),
            quantity.alias("quantity"),
        )
    )


_BRONZE_ORDERS_SQL = """
select o_orderkey as id, o_custkey as "userId", strftime(o_orderdate, '%Y-%m-%d') as date,
       o_orderstatus as status, last_day(o_orderdate::date) as ingest_date,
       count(l_orderkey) as items, sum(l_quantity)::bigint as quantity
from orders left join lineitem on l_orderkey = o_orderkey
group by o_orderkey, o_custkey, o_orderdate, o_orderstatus
"""


def _events_by_day(spark, folder):
    path = scratch.new_path(spark, "bronze-events")
    events = warehouse.events(spark, folder)
    write_events(events, path, F.to_date(F.to_timestamp("timestamp")))
    return path


def bronze_events(spark, folder):
    path = _events_by_day(spark, folder)
    return read_bronze(spark, path, "events").select(
        "event_id", "event_type", "timestamp", "user_id", "device", "ingest_date"
    )


_DEVICE = "list_extract(['desktop', 'mobile', 'tablet'], (props->>'$.k')::int % 3 + 1)"

_BRONZE_EVENTS_SQL = f"""
select event_id::varchar as event_id, event_type,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, user_id, {_DEVICE} as device,
       ts::date as ingest_date
from events
"""


def tolerant_json(spark, folder):
    """Lists and single objects, next to a broken file and one of another kind."""
    path = scratch.new_path(spark, "mixed")
    products = warehouse.products(spark, folder)
    first = products.agg(F.min("id")).scalar()
    single = F.col("id") == first
    write_documents(products.filter(~single), f"{path}/lists")
    products.filter(single).coalesce(1).write.json(f"{path}/objects")
    spark.range(1).select(F.lit('[{"id": 1, "title": ').alias("value")).coalesce(1).write.text(
        f"{path}/broken"
    )
    export_csv(products.select("id", "title"), f"{path}/other")
    found = read_documents(spark, path, BRONZE_PRODUCTS)
    return found.select("id", "title", F.col("price").cast("double").alias("price"), "category")


def day_partition(spark, folder):
    """The orders ingested on the last day there is."""
    path = scratch.new_path(spark, "days")
    documents = _order_documents(spark, folder)
    write_documents(documents, f"{path}/orders", "day")
    last = warehouse.table(spark, folder, "orders").agg(
        F.last_day(F.to_date(F.max("o_orderdate"))).alias("day")
    )
    return read_day(spark, path, "orders", last.first().day).select(
        "id", "userId", "date", "status", F.size("products").cast("bigint").alias("items")
    )


def dim_lookup(spark, folder):
    products = current_lookup(
        lake(spark, folder).table("dim_products"), "product_id", "price", "category"
    )
    return plain(products)


def stored_fact(spark, folder):
    fact = lake(spark, folder).table("fact_orders")
    return plain(fact, "product_key", "customer_key", "load_timestamp", "discount")


FACT_SQL = f"""
with {ITEMS_CTE}
select order_id, order_date, customer_id, product_id, category, quantity,
       revenue::double as revenue, cost::double as cost, profit::double as profit,
       year, month, day, status
from fact
"""


def stored_dims(spark, folder):
    house = lake(spark, folder)
    goods = house.table("dim_products").filter("is_current").select(
        F.lit("product").alias("dimension"), F.col("product_id").alias("id"),
        F.col("product_name").alias("name"), F.col("category").alias("folder"),
    )
    people = house.table("dim_customers").filter("is_current").select(
        F.lit("customer"), "customer_id", "full_name", "country"
    )
    days = house.table("dim_date").select(
        F.lit("day"), F.col("date_key").cast("string"), "day_name", "month_name"
    )
    return goods.unionAll(people).unionAll(days)


_STORED_DIMS_SQL = """
select 'product' as dimension, p_partkey::varchar as id, p_name as name, p_type as folder from part
union all
select 'customer', c_custkey::varchar, replace(c_name, '#', ' '), coalesce(r_name, 'US')
from customer left join nation on n_nationkey = c_nationkey
left join region on r_regionkey = n_regionkey
union all
select 'day', strftime(d, '%Y%m%d'), dayname(d), monthname(d)
from (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-31',
                                    interval 1 day)) as d)
"""


def discover_evolve(spark, folder):
    """Two deliveries, the second with one more column; both stay readable."""
    path = scratch.new_path(spark, "deliveries")
    parts = warehouse.table(spark, folder, "part")
    parts.drop("p_size").write.json(f"{path}/1")
    parts.write.json(f"{path}/2")
    found = [discover(spark, f"{path}/{n}", multi_line=False) for n in (1, 2)]
    return evolve(found)


def discover_root(spark, folder):
    """All bronze tables below one root, in three layouts, with their folder keys:
    rows by table and folder."""
    root = scratch.new_path(spark, "root")
    month = F.last_day(F.to_date("date"))
    write_bronze_json(warehouse.orders(spark, folder), f"{root}/orders", month)
    products = warehouse.products(spark, folder).select("*", _on(AS_OF))
    write_documents(products, f"{root}/products", "day")
    write_events(warehouse.events(spark, folder), f"{root}/events", F.to_date(F.to_timestamp("timestamp")))
    tables = discover_all(spark, root)
    keys = {"events": ("year", "month", "day"), "orders": ("ingest_date",), "products": ("date",)}
    parts = [
        tables[name].groupBy(F.concat_ws("-", *keys[name]).alias("folder")).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows")
        )
        for name in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def remembered(spark, folder):
    """Three deliveries of one table: the second lacks a column, has a new one and one of
    another type, the third is like it. The log of changes, and what SQL reads of the rows."""
    path, log = scratch.new_path(spark, "remembered"), scratch.new_path(spark, "known-columns")
    name = f"remembered_{uuid.uuid4().hex[:12]}"
    parts = warehouse.table(spark, folder, "part")
    first = parts.drop("p_size")
    second = parts.drop("p_brand").withColumn("p_retailprice", F.concat(F.lit("about "), "p_retailprice"))
    for k, rows in enumerate((first, second, second)):
        rows.write.json(f"{path}/{k}")
        found = discover(spark, f"{path}/{k}", multi_line=False).schema
        if not k:
            spark.catalog.createTable(name, path=path, source="json", schema=found, recursiveFileLookup="true")
        remember_schema(spark, log, "part", found, name, LOAD_TIME)
    changes = read_log(spark, log, KNOWN_COLUMNS).filter("change <> 'kept'").select(
        F.col("version").cast("bigint").alias("version"), "column_name", "change", "data_type", "found_type",
        F.lit(None).cast("bigint").alias("rows"),
    )
    counts = query(
        spark,
        f"""select cast(null as bigint) as version, stack(4, 'p_partkey', count(p_partkey), 'p_brand', count(p_brand),
                   'p_size', count(p_size), 'p_retailprice', count(p_retailprice)) as (column_name, rows) from {name}""",
    )
    empty = F.lit(None).cast("string")
    counts = counts.select("version", "column_name", F.lit("read").alias("change"), empty.alias("data_type"), empty.alias("found_type"), "rows")
    return changes.unionByName(counts)


_REMEMBERED_SQL = """
select 1::bigint as version, column_name, 'added' as change, data_type, data_type as found_type, null::bigint as rows
from (values ('p_partkey', 'bigint'), ('p_name', 'string'), ('p_brand', 'string'), ('p_type', 'string'),
             ('p_retailprice', 'double')) t(column_name, data_type)
union all select 2, 'p_brand', 'missing', 'string', null, null
union all select 2, 'p_size', 'added', 'bigint', 'bigint', null
union all select 2, 'p_retailprice', 'retyped', 'double', 'string', null
union all select null, 'p_partkey', 'read', null, null, 3 * count(*) from part
union all select null, 'p_brand', 'read', null, null, count(*) from part
union all select null, 'p_size', 'read', null, null, 2 * count(*) from part
union all select null, 'p_retailprice', 'read', null, null, count(*) from part
"""


def catalog_sql(spark, folder):
    tables = {name: warehouse.table(spark, folder, name) for name in ("orders", "lineitem")}
    register(spark, {f"catalog_{name}": df for name, df in tables.items()})
    return query(
        spark,
        """select o_orderstatus, count(*) as items,
                  cast(sum(cast(l_extendedprice as decimal(12,2))) as double) as price
           from catalog_orders join catalog_lineitem on l_orderkey = o_orderkey
           group by o_orderstatus""",
    )


def roundtrip_partitioned(spark, folder):
    """Products under categories that look like numbers, and one without any."""
    root = scratch.new_path(spark, "by-category")
    products = silver.clean_products(warehouse.products(spark, folder), LOAD_TIME)
    code = F.when(F.col("category") == "PROMO", "").when(F.col("category") == "SMALL", "007")
    products = products.withColumn("category", F.coalesce(code, "category"))
    write_table(products, f"{root}/dim_products", ["category"])
    return plain(read_table(spark, root, "dim_products"), "product_key", "load_timestamp")


def roundtrip_all(spark, folder):
    """Rows and sums of every partitioned table, as read back under its schema."""
    house = lake(spark, folder)
    house.build_gold(LOAD_TIME, THRESHOLDS)
    measures = {
        "dim_products": ("category", "price"),
        "dim_customers": ("country", "lifetime_value"),
        "fact_orders": ("year", "revenue"),
        "daily_sales_summary": ("month", "total_revenue"),
        "product_performance": ("category", "total_revenue"),
        "customer_360": ("country", "lifetime_revenue"),
        "category_analysis": ("category", "total_revenue"),
    }
    parts = [
        house.table(name).groupBy(F.col(key).cast("string").alias("key")).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows"),
            F.sum(value).cast("double").alias("total"),
        )
        for name, (key, value) in measures.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_ALL_SQL = f"""
with {ITEMS_CTE},
people as (
  select c_custkey::varchar as customer_id, upper(coalesce(r_name, 'US')) as country
  from customer left join nation on n_nationkey = c_nationkey
  left join region on r_regionkey = n_regionkey
),
days as (select order_date, month, sum(revenue) as revenue from fact group by all),
products as (select product_id, category, sum(revenue) as revenue from fact group by all),
buyers as (select country, sum(revenue) as revenue from people left join fact using (customer_id)
           group by customer_id, country),
months as (select category, year, month, sum(revenue) as revenue from fact group by all)
select upper(trim(p_type)) as key, 'dim_products' as table_name, count(*) as rows,
       sum(p_retailprice::decimal(10,2))::double as total from part group by 1
union all select country, 'dim_customers', count(*), 0::double from people group by 1
union all select year::varchar, 'fact_orders', count(*), sum(revenue)::double from fact group by 1
union all select month::varchar, 'daily_sales_summary', count(*), sum(revenue)::double from days group by 1
union all select category, 'product_performance', count(*), sum(revenue)::double from products group by 1
union all select country, 'customer_360', count(*), coalesce(sum(revenue), 0)::double from buyers group by 1
union all select category, 'category_analysis', count(*), sum(revenue)::double from months group by 1
"""


def roundtrip_flat(spark, folder):
    path = scratch.new_path(spark, "flat")
    write_table(warehouse.table(spark, folder, "customer"), path)
    return spark.read.parquet(path)


def dynamic_overwrite(spark, folder):
    """Everything written as version 1, the years from 2000 on again as version 2."""
    path = scratch.new_path(spark, "versions")
    orders = warehouse.table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("order_year")
    )
    write_table(orders.withColumn("version", F.lit(1)), path, ["order_year"])
    again = orders.filter(F.col("order_year") >= 2000).withColumn("version", F.lit(2))
    write_table(again, path, ["order_year"], incremental=True)
    return spark.read.parquet(path).select("o_orderkey", "version", "order_year")


def bronze_json(spark, folder):
    """JSON lines by ingest day, read back with the default reader, with all items."""
    path = scratch.new_path(spark, "lines")
    write_bronze_json(warehouse.orders(spark, folder), path, F.last_day(F.to_date("date")))
    items = F.coalesce(F.size("products"), F.lit(0)).cast("bigint")
    each = F.transform("products", lambda p: F.concat_ws(":", p["productId"], p["quantity"]))
    return read_bronze(spark, path, "orders").select(
        "id", "userId", "date", "status", "ingest_date", items.alias("items"),
        F.array_join(F.array_sort(each), ",").alias("products"),
    )


def events_by_day(spark, folder):
    """All events with the keys of the folder that each was written to."""
    day = r"/year=(\d+)/month=(\d+)/day=(\d+)/"
    keys = [F.regexp_extract("source_file", day, k + 1).alias(c) for k, c in enumerate(("year", "month", "day"))]
    return read_bronze(spark, _events_by_day(spark, folder), "events").select("event_id", *keys)


def event_day(spark, folder):
    """The events of the last day there is, read by day with the default reader."""
    path = scratch.new_path(spark, "bronze")
    events = warehouse.events(spark, folder)
    write_events(events, f"{path}/events", F.to_date(F.to_timestamp("timestamp")))
    last = warehouse.table(spark, folder, "events").agg(F.to_date(F.max("ts")).alias("day"))
    return read_day(spark, path, "events", last.first().day).select(
        "event_id", "event_type", "timestamp", "user_id", "device"
    )


def pretty_arrays(spark, folder):
    """Arrays printed over many lines, one file a category, beside files of lines."""
    path = scratch.new_path(spark, "pretty")
    products = warehouse.products(spark, folder)
    printed = products.filter("id % 3 <> 0").select("category", F.to_json(F.struct("*"), {"pretty": "true"}).alias("text"))
    arrays = printed.groupBy("category").agg(F.array_join(F.collect_list("text"), ",\n").alias("text"))
    arrays.select(F.concat(F.lit("[\n"), "text", F.lit("\n]")).alias("value")).repartition(8).write.option(
        "maxRecordsPerFile", 1
    ).text(f"{path}/date={AS_OF}")
    write_bronze_json(products.filter("id % 3 = 0"), path, F.lit(AS_OF))
    return read_bronze(spark, path, "products").select(
        "id", "title", F.col("price").cast("double").alias("price"), "category", "rating.count", "ingest_date"
    )


def csv_export(spark, folder):
    path = scratch.new_path(spark, "csv")
    people = warehouse.table(spark, folder, "customer")
    export_csv(people, path)
    return spark.read.schema(people.schema).option("header", True).csv(path)


def rows_in_and_out(spark, folder):
    house = lake(spark, folder)
    bronze = warehouse.bronze(spark, folder)
    return run_summary(
        {
            "dim_products": (bronze["products"], house.table("dim_products")),
            "dim_customers": (bronze["customers"], house.table("dim_customers")),
            "fact_orders": (warehouse.items(spark, folder), house.table("fact_orders")),
        }
    )


QUERIES = {
    "src_bronze_products": (bronze_products, _BRONZE_PRODUCTS_SQL),
    "src_bronze_customers": (bronze_customers, _BRONZE_CUSTOMERS_SQL),
    "src_bronze_orders": (bronze_orders, _BRONZE_ORDERS_SQL),
    "src_bronze_events": (bronze_events, _BRONZE_EVENTS_SQL),
    "src_tolerant_json": (
        tolerant_json,
        "select p_partkey as id, p_name as title, p_retailprice as price, p_type as category from part",
    ),
    "src_day_partition": (
        day_partition,
        """select o_orderkey as id, o_custkey as "userId",
                  strftime(o_orderdate, '%Y-%m-%d') as date, o_orderstatus as status,
                  nullif(count(l_orderkey), 0) as items
           from orders left join lineitem on l_orderkey = o_orderkey
           where last_day(o_orderdate::date) = (select last_day(max(o_orderdate)::date) from orders)
           group by o_orderkey, o_custkey, o_orderdate, o_orderstatus
        """,
    ),
    "src_dim_lookup": (
        dim_lookup,
        """select p_partkey::varchar as product_id, p_retailprice::double as price,
                  p_type as category from part""",
    ),
    "src_fact": (stored_fact, FACT_SQL),
    "src_dim_gold": (stored_dims, _STORED_DIMS_SQL),
    "cat_discover_evolve": (
        discover_evolve,
        """select * replace (null::bigint as p_size) from part
           union all select * replace (p_size::bigint as p_size) from part""",
    ),
    "cat_discover_root": (
        discover_root,
        f"""select strftime(last_day(o_orderdate::date), '%Y-%m-%d') as folder, 'orders' as table_name,
                   count(*) as rows from orders group by 1
            union all select '{AS_OF}', 'products', count(*) from part
            union all select strftime(ts, '%Y-%m-%d'), 'events', count(*) from events group by 1""",
    ),
    "cat_remembered": (remembered, _REMEMBERED_SQL),
    "cat_sql": (
        catalog_sql,
        """select o_orderstatus, count(*) as items,
                  sum(l_extendedprice::decimal(12,2))::double as price
           from orders join lineitem on l_orderkey = o_orderkey group by o_orderstatus""",
    ),
    "sink_roundtrip_partitioned": (
        roundtrip_partitioned,
        f"""select * replace (nullif(case category when 'PROMO' then '' when 'SMALL' then '007'
                                     else category end, '') as category)
            from ({PRODUCTS_SQL})""",
    ),
    "sink_roundtrip_all": (roundtrip_all, _ALL_SQL),
    "sink_roundtrip_flat": (roundtrip_flat, "select * from customer"),
    "sink_dynamic_overwrite": (
        dynamic_overwrite,
        """select o_orderkey, (case when year(o_orderdate) >= 2000 then 2 else 1 end)::int
                  as version, year(o_orderdate)::int as order_year from orders""",
    ),
    "sink_bronze_json": (
        bronze_json,
        """select o_orderkey as id, o_custkey as "userId",
                  strftime(o_orderdate, '%Y-%m-%d') as date, o_orderstatus as status,
                  last_day(o_orderdate::date) as ingest_date, count(l_orderkey) as items,
                  string_agg(l_partkey || ':' || l_quantity::bigint, ','
                             order by l_partkey || ':' || l_quantity::bigint) as products
           from orders left join lineitem on l_orderkey = o_orderkey
           group by o_orderkey, o_custkey, o_orderdate, o_orderstatus""",
    ),
    "sink_bronze_events": (
        events_by_day,
        """select event_id::varchar as event_id, strftime(ts, '%Y') as year,
                  strftime(ts, '%m') as month, strftime(ts, '%d') as day from events""",
    ),
    "src_event_day": (
        event_day,
        f"""select event_id::varchar as event_id, event_type,
                   strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, user_id, {_DEVICE} as device
            from events where ts::date = (select max(ts)::date from events)""",
    ),
    "src_pretty_arrays": (
        pretty_arrays,
        f"""select p_partkey as id, p_name as title, p_retailprice as price, p_type as category,
                   (p_size * 10)::bigint as count, date '{AS_OF}' as ingest_date from part""",
    ),
    "sink_csv_export": (csv_export, "select * from customer"),
    "run_summary": (
        rows_in_and_out,
        """select 'dim_products' as table_name, count(*) as rows_in, count(*) as rows_out,
                  0::bigint as removed from part
           union all select 'dim_customers', count(*), count(*), 0 from customer
           union all select 'fact_orders', count(*), count(o_orderkey),
                            count(*) - count(o_orderkey)
             from lineitem left join orders on o_orderkey = l_orderkey""",
    ),
}
