"""Queries over watermarks, incremental loads and the file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import scratch
from ..plans.ingest import Ingest
from ..plans.lakehouse import Lakehouse
from ..schemas import BRONZE, PARTITIONING
from ..session import fitted_shuffles, small_scans
from ..sinks import write_bronze_json, write_table
from ..sources import warehouse
from ..streaming import (
    current_watermarks,
    filter_since,
    last_run,
    load_available,
    record_run,
    upsert_orders,
)
from .common import ITEMS_CTE, LOAD_TIME, lake, plain
from .files import FACT_SQL


def watermark_upsert(spark, folder):
    """A log with one run per order, loads being named by priority: last one wins."""
    path = scratch.new_path(spark, "watermarks")
    runs = warehouse.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("pipeline_name"),
        F.to_date("o_orderdate").alias("last_run_date"),
        (
            F.timestamp_seconds(F.unix_date(F.to_date("o_orderdate")) * 86400 + F.col("o_orderkey"))
        ).alias("last_run_timestamp"),
        F.lit("completed").alias("status"),
    )
    runs.write.mode("append").parquet(path)
    text = F.date_format("last_run_timestamp", "yyyy-MM-dd HH:mm:ss")
    return current_watermarks(spark, path).withColumn("last_run_timestamp", text)


_UPSERT_SQL = """
with log as (
  select o_orderpriority as pipeline_name, o_orderdate::date as last_run_date,
         o_orderdate::date + to_seconds(o_orderkey) as run_at, 'completed' as status
  from orders
)
select pipeline_name, arg_max(last_run_date, run_at) as last_run_date,
       strftime(max(run_at), '%Y-%m-%d %H:%M:%S') as last_run_timestamp, 'completed' as status
from log group by pipeline_name
"""


def by_watermark(spark, folder):
    path = scratch.new_path(spark, "watermarks")
    record_run(spark, path, "orders", "2001-05-01", "2001-05-01 06:00:00")
    record_run(spark, path, "orders", "2001-07-01", "2001-07-01 06:00:00")
    headers = warehouse.table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date")
    )
    return filter_since(headers, "order_date", last_run(spark, path, "orders"))


def fact_upsert(spark, folder):
    """The fact of the orders before 2000 brought up to date with those since 1999."""
    house = lake(spark, folder)
    fact = house.table("fact_orders")
    path = scratch.new_path(spark, "fact")
    # The silver fact is kept by month, so its rows come gathered.
    with small_scans(spark):
        write_table(fact.filter("order_date < '2000-01-01'"), path, PARTITIONING["fact_orders"], gathered=True)
    upsert_orders(spark, path, fact.filter("order_date >= '1999-01-01'"), stored=True)
    stored = spark.read.schema(fact.schema).parquet(path).select(fact.columns)
    return plain(stored, "product_key", "customer_key", "load_timestamp", "discount")


def stream_available(spark, folder):
    """Load the day folders of the orders, ask for more, and read what was stored.

    The documents' own dates differ from the days of their folders."""
    source = scratch.new_path(spark, "bronze-orders")
    orders = warehouse.orders(spark, folder)
    write_bronze_json(orders, source, F.last_day(F.to_date("date")))
    target = scratch.new_path(spark, "orders")
    checkpoint = scratch.new_path(spark, "orders-checkpoint")
    for _ in range(2):
        load_available(spark, source, target, BRONZE["orders"], checkpoint)
    return spark.read.parquet(target).select(
        "id", "date", "status", "ingest_date", F.col("batch_id").cast("bigint").alias("batch_id"),
        F.coalesce(F.size("products"), F.lit(0)).cast("bigint").alias("items"),
    )


_STREAM_SQL = """
select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d') as date, o_orderstatus as status,
       last_day(o_orderdate::date) as ingest_date, 0::bigint as batch_id,
       count(l_orderkey) as items
from orders left join lineitem on l_orderkey = o_orderkey
group by o_orderkey, o_orderdate, o_orderstatus
"""


def daily_run(spark, folder):
    """The fact brought up to date day by day: everything on the first day, on the
    second the orders of 2001 again with another status; both days asked for twice."""
    root, lake_root = scratch.new_path(spark, "daily-bronze"), scratch.new_path(spark, "daily-lake")
    with (
        fitted_shuffles(spark, warehouse.paths(folder)),
        small_scans(spark),
        scratch.materialized(warehouse.orders(spark, folder), "order-documents") as orders,
    ):
        again = orders.filter("date >= '2001-01-01'").withColumn("status", F.lit("again"))
        # Of one day each, so nothing is moved to gather them.
        write_bronze_json(orders, f"{root}/orders", F.lit("2001-08-01").cast("date"), gathered=True, compression="gzip")
        write_bronze_json(again, f"{root}/orders", F.lit("2001-08-02").cast("date"), gathered=True, compression="gzip")
    house = Lakehouse(spark, lake_root)
    with fitted_shuffles(spark, warehouse.paths(folder)):
        house.build_dimensions(warehouse.bronze(spark, folder), LOAD_TIME)
    loads = Ingest(house, root)
    for day in ("2001-08-01", "2001-08-01", "2001-08-02", "2001-08-02"):
        loads.load("orders", LOAD_TIME, day)
    return plain(house.table("fact_orders"), "product_key", "customer_key", "load_timestamp", "discount")


_DAILY_SQL = f"""
select * replace (case when order_date >= date '2001-01-01' then 'again' else status end as status)
from ({FACT_SQL})
"""


def _deliver(folder, df, root, table, day, part=""):
    """Documents of a table in the folder of a day, or of a part of it that sorts later."""
    path = f"{root}/{table}/ingest_date={day}{part}"
    with fitted_shuffles(df.sparkSession, warehouse.paths(folder)), small_scans(df.sparkSession):
        df.write.mode("append").json(path, compression="gzip")


def _delivered(spark, folder, root):
    """What has arrived when loads are run for the first, second and third time.

    Late are: the parts of one brand, the day of the orders before 1998, with outdated
    copies of those since 2000, and a file with the orders of 2001 under another status in
    the folder of a day that is loaded by then. A third of the events comes twice."""
    bronze = warehouse.bronze(spark, folder)
    products, customers, events = (bronze[n] for n in ("products", "customers", "events"))
    with fitted_shuffles(spark, warehouse.paths(folder)), small_scans(spark):
        # Put together once for all deliveries.
        orders = scratch.materialize(bronze["orders"], "order-documents")
    brand = F.col("description") == "Brand#2"
    _deliver(folder, products.filter(~brand), root, "products", "2001-08-01")
    _deliver(folder, customers, root, "customers", "2001-08-01")
    _deliver(folder, orders.filter("date >= '1998-01-01'"), root, "orders", "2001-08-02")
    half = F.col("event_id").cast("long") % 3
    _deliver(folder, events.filter(half != 0), root, "events", "2001-08-02")
    yield
    _deliver(folder, products.filter(brand), root, "products", "2001-08-03")
    old = orders.filter("date >= '2000-01-01'").withColumn("status", F.lit("outdated"))
    _deliver(folder, orders.filter("date < '1998-01-01'").unionByName(old), root, "orders", "2001-08-01")
    again = orders.filter("date >= '2001-01-01'").withColumn("status", F.lit("again"))
    _deliver(folder, again, root, "orders", "2001-08-02", "/zz-added")
    _deliver(folder, events.filter(half != 1), root, "events", "2001-08-01")
    yield
    yield


def _all_tables(house):
    """Items, events and both dimensions as rows of one shape."""
    item = house.table("fact_orders").select(
        F.lit("item").alias("kind"), F.col("order_id").alias("id"), F.col("product_id").alias("about"),
        F.col("status").alias("value"), F.col("revenue").cast("double").alias("amount"), F.col("order_date").alias("day"),
    )
    event = house.table("events").select(
        F.lit("event"), "event_id", "customer_id", "event_type", F.lit(None).cast("double"), "event_date"
    )
    product = house.table("dim_products").select(
        F.lit("product"), "product_id", "category", "product_name", F.col("price").cast("double"), F.lit(None).cast("date")
    )
    person = house.table("dim_customers").select(
        F.lit("customer"), "customer_id", "country", "full_name", F.lit(None).cast("double"), F.lit(None).cast("date")
    )
    return item.unionAll(event).unionAll(product).unionAll(person)


def all_pipelines(spark, folder):
    """All four pipelines loaded three times, with days and files that come late."""
    root = scratch.new_path(spark, "loads-bronze")
    house = Lakehouse(spark, scratch.new_path(spark, "loads-lake"))
    loads = Ingest(house, root)
    for _ in _delivered(spark, folder, root):
        files = loads.load_all(LOAD_TIME)
    if any(files.values()):
        raise AssertionError(f"loaded again: {files}")
    return _all_tables(house)


_ALL_TABLES_SQL = f"""
with {ITEMS_CTE}
select 'item' as kind, order_id as id, product_id as about,
       case when order_date >= date '2001-01-01' then 'again' else status end as value,
       revenue::double as amount, order_date as day
from fact
union all
select 'event', event_id::varchar, user_id::varchar, event_type, null, ts::date from events
union all
select 'product', p_partkey::varchar, p_type, p_name, p_retailprice::decimal(10,2)::double, null from part
union all
select 'customer', c_custkey::varchar, coalesce(r_name, 'US'), replace(c_name, '#', ' '), null, null
from customer left join nation on n_nationkey = c_nationkey
left join region on r_regionkey = n_regionkey
"""


def stream_fact(spark, folder):
    """Orders and events merged by streams: a batch, then one that delivers much of it
    again, then none; the dimensions are there before."""
    root = scratch.new_path(spark, "stream-bronze")
    house = Lakehouse(spark, scratch.new_path(spark, "stream-lake"))
    loads = Ingest(house, root)
    checks = {n: scratch.new_path(spark, f"{n}-check") for n in ("orders", "events")}
    with fitted_shuffles(spark, warehouse.paths(folder)):
        house.build_dimensions(warehouse.bronze(spark, folder), LOAD_TIME)
    for _ in _delivered(spark, folder, root):
        for name, checkpoint in checks.items():
            loads.stream(name, checkpoint, LOAD_TIME)
    return _all_tables(house)


def rejects_replayed(spark, folder):
    """Orders loaded before the parts of two brands are known, and without the customers
    in debt; then one brand comes. Every delivered item is either stored or kept with the
    reason why it is not."""
    root = scratch.new_path(spark, "rejects-bronze")
    house = Lakehouse(spark, scratch.new_path(spark, "rejects-lake"))
    loads = Ingest(house, root)
    bronze = warehouse.bronze(spark, folder)
    brand = F.col("description")
    debtors = warehouse.table(spark, folder, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    _deliver(folder, bronze["products"].filter(~brand.isin("Brand#2", "Brand#3")), root, "products", "2001-08-01")
    _deliver(folder, bronze["customers"].join(debtors, "id", "left_anti"), root, "customers", "2001-08-01")
    _deliver(folder, bronze["orders"], root, "orders", "2001-08-01")
    loads.load_all(LOAD_TIME)
    _deliver(folder, bronze["products"].filter(brand == "Brand#2"), root, "products", "2001-08-02")
    for _ in range(2):
        loads.load_all(LOAD_TIME)
    columns = ["order_id", "product_id", "quantity", "order_date"]
    stored = house.table("fact_orders").select(*columns, F.lit(None).cast("string").alias("reason"))
    kept = house.table("rejected_orders").filter("reason is not null").select(*columns, "reason")
    return stored.unionAll(kept)


_REJECTS_SQL = """
select o_orderkey::varchar as order_id, l_partkey::varchar as product_id, l_quantity::int as quantity,
       o_orderdate::date as order_date,
       case when p_brand = 'Brand#3' then 'unknown product'
            when c_acctbal < 0 then 'unknown customer' end as reason
from orders join lineitem on l_orderkey = o_orderkey
join part on p_partkey = l_partkey join customer on c_custkey = o_custkey
"""


QUERIES = {
    "inc_all_pipelines": (all_pipelines, _ALL_TABLES_SQL),
    "inc_stream_fact": (stream_fact, _ALL_TABLES_SQL),
    "inc_rejects_replayed": (rejects_replayed, _REJECTS_SQL),
    "inc_fact_upsert": (fact_upsert, FACT_SQL),
    "inc_watermark_upsert": (watermark_upsert, _UPSERT_SQL),
    "inc_filter_by_watermark": (
        by_watermark,
        """select o_orderkey, o_custkey, o_orderdate::date as order_date from orders
           where o_orderdate::date > date '2001-07-01'""",
    ),
    "inc_daily_run": (daily_run, _DAILY_SQL),
    "inc_stream_available_now": (
        stream_available,
        _STREAM_SQL,
    ),
}
