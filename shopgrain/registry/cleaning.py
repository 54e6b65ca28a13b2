"""Queries over the silver builders and the operators they use."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import run_time
from ..operators import explode_items, latest_per_key, lookup, nest_items, open_versions, unmatched
from ..plans import silver
from ..sources import warehouse
from .common import AS_OF, ITEMS_CTE, LOAD_TIME, plain


def _dims(spark, folder):
    return (
        silver.clean_products(warehouse.products(spark, folder), LOAD_TIME),
        silver.clean_customers(warehouse.customers(spark, folder), LOAD_TIME),
    )


def dim_date(spark, folder):
    days = F.to_date("o_orderdate")
    # Whole years, from the first to the last one with an order.
    span = warehouse.table(spark, folder, "orders").agg(
        F.min(days).alias("first"), F.max(days).alias("last")
    )
    bounds = span.select(
        F.explode(
            F.array(
                F.trunc("first", "year"), F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
            )
        ).alias("day")
    )
    return silver.date_dimension(spark, days_of=F.col("day"), orders=bounds)


_DATE_SQL = """
with span as (
  select min(date_trunc('year', o_orderdate))::date as a,
         (max(date_trunc('year', o_orderdate)) + interval 1 year - interval 1 day)::date as b
  from orders
), days as (
  select unnest(generate_series(a::timestamp, b::timestamp, interval 1 day))::date as date from span
)
select date, year(date)::int as year, quarter(date)::int as quarter, month(date)::int as month,
       monthname(date) as month_name, week(date)::int as week, day(date)::int as day,
       isodow(date)::int as day_of_week, dayname(date) as day_name,
       isodow(date) >= 6 as is_weekend, false as is_holiday,
       (year(date) * 10000 + month(date) * 100 + day(date))::int as date_key
from days
"""


def silver_products(spark, folder):
    return plain(_dims(spark, folder)[0], "product_key", "load_timestamp")


PRODUCTS_SQL = f"""
select p_partkey::varchar as product_id, trim(p_name) as product_name,
       upper(trim(p_type)) as category, p_retailprice::decimal(10,2)::double as price,
       (p_size % 5 + 0.5)::double as rating, (p_size * 10)::int as review_count,
       p_brand as product_description, '/img/' || p_partkey || '.jpg' as image_url,
       date '{AS_OF}' as effective_date, date '2099-12-31' as expiration_date,
       true as is_current
from part
"""


def silver_customers(spark, folder):
    return plain(_dims(spark, folder)[1], "customer_key", "load_timestamp")


_CUSTOMERS_SQL = f"""
select c_custkey::varchar as customer_id, replace(c_name, '#', ' ') as full_name,
       split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
       lower(c_name) || '@email.com' as email, regexp_replace(c_name, '[^0-9]', '', 'g') as phone,
       c_mktsegment as street, n_name as city, lpad(c_nationkey::varchar, 5, '0') as zipcode,
       upper(coalesce(r_name, 'US')) as country,
       case when c_custkey % 10 = 0 then 'VIP' when c_custkey % 5 = 0 then 'ACTIVE'
            else 'NEW' end as segment,
       0::double as lifetime_value, date '{AS_OF}' as effective_date,
       date '2099-12-31' as expiration_date, true as is_current
from customer left join nation on n_nationkey = c_nationkey
left join region on r_regionkey = n_regionkey
"""


def silver_order_items(spark, folder):
    """Two deliveries of every order, of which the last one counts: the first came
    without its last item and with another status."""
    products, customers = _dims(spark, folder)
    orders = warehouse.orders(spark, folder)
    last = orders.withColumn("ingest_date", F.lit("2001-08-02").cast("date"))
    first = orders.withColumns(
        {
            "products": F.expr("slice(products, 1, size(products) - 1)"),
            "status": F.lit("open"),
            "ingest_date": F.lit("2001-08-01").cast("date"),
        }
    )
    fact = silver.order_items(first.unionByName(last), products, customers, LOAD_TIME, dedup=True)
    return plain(fact, "product_key", "customer_key", "load_timestamp")


_ITEMS_SQL = f"""
with {ITEMS_CTE}
select order_id, order_date, customer_id, product_id, category, quantity,
       revenue::double as revenue, cost::double as cost, profit::double as profit,
       0::double as discount, year, month, day, status
from fact
"""


def dedup_products(spark, folder):
    """Two deliveries of every product; the later one has another price."""
    first = warehouse.products(spark, folder).withColumn(
        "ingest_date", F.lit("2001-08-01").cast("date")
    )
    later = first.withColumns(
        {
            "price": (F.col("price").cast("decimal(10,2)") + 1).cast("string"),
            "ingest_date": F.lit("2001-08-02").cast("date"),
        }
    )
    kept = latest_per_key(first.unionByName(later), ["id"], ["ingest_date"])
    return kept.select(
        "id", "title", F.col("price").cast("double").alias("price"), "ingest_date"
    )


def dedup_customers(spark, folder):
    """Every customer once more, with the email in upper case and padded."""
    first = warehouse.customers(spark, folder).withColumn(
        "ingest_date", F.lit("2001-08-01").cast("date")
    )
    again = first.withColumns(
        {
            "email": F.concat(F.lit(" "), F.upper("email"), F.lit(" ")),
            "ingest_date": F.lit("2001-08-02").cast("date"),
        }
    )
    kept = silver.one_per_email(first.unionByName(again))
    return kept.select("id", "email", "ingest_date")


def surrogate_keys(spark, folder):
    """Rows and distinct keys of both dimensions; the two must be equal."""
    products, customers = _dims(spark, folder)

    def count(df, name, key):
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.count_distinct(key).alias("distinct_keys"),
        )

    return count(products, "dim_products", "product_key").unionAll(
        count(customers, "dim_customers", "customer_key")
    )


def scd2_stamp(spark, folder):
    parts = warehouse.table(spark, folder, "part").select("p_partkey", "p_name")
    stamped = open_versions(parts, "part_key", "p_partkey", run_time(LOAD_TIME))
    loaded = F.date_format("load_timestamp", "yyyy-MM-dd HH:mm:ss")
    return stamped.withColumn("load_timestamp", loaded).drop("part_key")


# The test tables have no unknown keys, so these joins meet a catalogue without
# one category and a customer list without one market segment.
def _sold_items(spark, folder):
    return warehouse.items(spark, folder).withColumnsRenamed(
        {"id": "order_id", "productId": "product_id"}
    )


def _goods(spark, folder):
    return (
        warehouse.table(spark, folder, "part")
        .filter(F.col("p_type") != "PROMO")
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
        )
    )


def join_left_products(spark, folder):
    return lookup(_sold_items(spark, folder), _goods(spark, folder), "product_id")


def join_left_customers(spark, folder):
    people = (
        warehouse.table(spark, folder, "customer")
        .filter(F.col("c_mktsegment") != "BUILDING")
        .select(F.col("c_custkey").alias("customer_id"), "c_name")
    )
    headers = warehouse.order_headers(spark, folder).select(
        F.col("id").alias("order_id"), F.col("userId").alias("customer_id")
    )
    items = _sold_items(spark, folder).join(headers, "order_id")
    return lookup(items, people, "customer_id")


def join_rejects_anti(spark, folder):
    return unmatched(_sold_items(spark, folder), _goods(spark, folder), "product_id")


def _nested(spark, folder):
    """One row per order that has items."""
    fields = {"productId": F.col("productId"), "quantity": F.col("quantity")}
    return nest_items(warehouse.items(spark, folder), ["id"], fields, "products")


def explode_order_items(spark, folder):
    return explode_items(warehouse.orders(spark, folder), "products", {"product_id": "productId", "quantity": "quantity"})


def nest_order_items(spark, folder):
    def total(acc, item):
        return acc + item["quantity"]

    zero = F.lit(0).cast("bigint")
    return (
        _nested(spark, folder)
        .select(
            "id",
            F.size("products").alias("n"),
            F.aggregate("products", zero, total).alias("q"),
            F.element_at("products", 1)["productId"].alias("first_product"),
        )
        .select("id", F.col("n").cast("bigint").alias("items"), F.col("q").alias("quantity"), "first_product")
    )


QUERIES = {
    "dim_date": (dim_date, _DATE_SQL),
    "silver_products": (silver_products, PRODUCTS_SQL),
    "silver_customers": (silver_customers, _CUSTOMERS_SQL),
    "silver_order_items": (silver_order_items, _ITEMS_SQL),
    "dedup_products": (
        dedup_products,
        """select p_partkey as id, p_name as title,
                  (p_retailprice::decimal(10,2) + 1)::double as price,
                  date '2001-08-02' as ingest_date from part""",
    ),
    "dedup_customers": (
        dedup_customers,
        """select c_custkey as id, ' ' || upper(c_name) || '@EMAIL.COM ' as email,
                  date '2001-08-02' as ingest_date from customer""",
    ),
    "surrogate_keys": (
        surrogate_keys,
        """select 'dim_products' as table_name, count(*) as row_count, count(*) as distinct_keys
           from part union all
           select 'dim_customers', count(*), count(*) from customer""",
    ),
    "scd2_stamp": (
        scd2_stamp,
        f"""select p_partkey, p_name, date '{AS_OF}' as effective_date,
                   date '2099-12-31' as expiration_date, true as is_current,
                   '{LOAD_TIME}' as load_timestamp from part""",
    ),
    "join_left_products": (
        join_left_products,
        """select l_orderkey as order_id, l_partkey as product_id,
                  l_quantity::bigint as quantity, p_type as category, p_retailprice as price
           from lineitem left join (select * from part where p_type <> 'PROMO')
             on p_partkey = l_partkey""",
    ),
    "join_left_customers": (
        join_left_customers,
        """select l_orderkey as order_id, l_partkey as product_id,
                  l_quantity::bigint as quantity, o_custkey as customer_id, c_name
           from lineitem join orders on o_orderkey = l_orderkey
           left join (select * from customer where c_mktsegment <> 'BUILDING')
             on c_custkey = o_custkey""",
    ),
    "join_rejects_anti": (
        join_rejects_anti,
        """select l_orderkey as order_id, l_partkey as product_id,
                  l_quantity::bigint as quantity
           from lineitem where l_partkey not in (select p_partkey from part where p_type <> 'PROMO')
        """,
    ),
    "explode_order_items": (
        explode_order_items,
        """select o_orderkey as id, o_custkey as "userId",
                  strftime(o_orderdate, '%Y-%m-%d') as date, o_orderstatus as status,
                  l_partkey as product_id, l_quantity::bigint as quantity
           from orders join lineitem on l_orderkey = o_orderkey""",
    ),
    "nest_order_items": (
        nest_order_items,
        """select l_orderkey as id, count(*) as items, sum(l_quantity)::bigint as quantity,
                  min(l_partkey) as first_product from lineitem group by l_orderkey""",
    ),
}
