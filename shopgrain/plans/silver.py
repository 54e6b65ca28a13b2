"""Silver layer: cleaned dimensions, calendar and the order-item fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (
    calendar_columns,
    clean_text,
    customer_tier,
    digits_only,
    full_name,
    line_metrics,
    run_time,
    to_day,
)
from ..operators import latest_per_key, lookup, open_versions

When = dt.datetime | str | None

# What tells apart two deliveries of the same record, oldest first.
_DELIVERY = ("ingest_date", "source_file")


def _delivery(df: DataFrame) -> list[str]:
    return [c for c in _DELIVERY if c in df.columns]


def one_per_product(bronze: DataFrame) -> DataFrame:
    """The last valid delivery of each product."""
    valid = bronze.filter(F.col("id").isNotNull() & (number_or_null("price", "double") > 0))
    return latest_per_key(valid, ["id"], _delivery(valid))


def clean_products(bronze: DataFrame, as_of: When = None) -> DataFrame:
    """``dim_products``: the last valid delivery of each product."""
    price = number_or_null("price", "decimal(10,2)")
    one_each = one_per_product(bronze)
    cleaned = one_each.select(
        F.col("id").cast("string").alias("product_id"),
        clean_text("title").alias("product_name"),
        F.upper(clean_text("category")).alias("category"),
        price.alias("price"),
        number_or_null(default_if_missing("rating.rate", 0.0), "decimal(3,2)").alias("rating"),
        number_or_null(default_if_missing("rating.count", 0), "int").alias("review_count"),
        F.col("description").alias("product_description"),
        F.col("image").alias("image_url"),
    )
    return open_versions(cleaned, "product_key", "product_id", run_time(as_of)).select(
        schemas.DIM_PRODUCTS.names
    )


def one_per_email(bronze: DataFrame, normalise: bool = True) -> DataFrame:
    """The last delivery per email, compared trimmed and in lower case by default."""
    with_email = bronze.filter(F.col("email").isNotNull())
    if not normalise:
        return latest_per_key(with_email, ["email"], _delivery(bronze))
    keyed = with_email.withColumn("_email", F.lower(clean_text("email")))
    return latest_per_key(keyed, ["_email"], _delivery(bronze)).drop("_email")


def clean_customers(bronze: DataFrame, as_of: When = None, normalise: bool = True) -> DataFrame:
    """``dim_customers``: one current row per email and per customer id."""
    # Rows without an id cannot stand for the same customer, so they stay apart.
    identity = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("email "), "email"))
    people = one_per_email(bronze, normalise).withColumn("_identity", identity)
    people = latest_per_key(people, ["_identity"], _delivery(people))
    customer_id = F.col("id").cast("string")
    first, last = clean_text("name.firstname"), clean_text("name.lastname")
    cleaned = people.select(
        customer_id.alias("customer_id"),
        full_name(first, last).alias("full_name"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.lower(clean_text("email")).alias("email"),
        digits_only("phone").alias("phone"),
        clean_text("address.street").alias("street"),
        clean_text("address.city").alias("city"),
        clean_text("address.zipcode").alias("zipcode"),
        F.upper(clean_text(default_if_missing("address.country", "US"))).alias("country"),
        customer_tier(customer_id).alias("segment"),
        F.lit(0).cast("decimal(10,2)").alias("lifetime_value"),
    )
    identity = F.coalesce("customer_id", "email")
    return open_versions(cleaned, "customer_key", identity, run_time(as_of)).select(
        schemas.DIM_CUSTOMERS.names
    )


def date_dimension(
    spark: SparkSession,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    days_of: Column | None = None,
    orders: DataFrame | None = None,
) -> DataFrame:
    """``dim_date``: every day from ``start`` to ``end``, both included.

    Without bounds the calendar runs from the first to the last day found in
    ``orders`` by the expression ``days_of``.
    """
    if start is not None and end is not None:
        span = spark.range(1).select(
            F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
        )
    elif orders is not None and days_of is not None:
        span = orders.agg(F.min(days_of).alias("start"), F.max(days_of).alias("end"))
    else:
        raise ValueError("give start and end, or orders and days_of")
    days = span.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date"))
    return days.select(*calendar_columns("date"))


def default_if_missing(column: str, default: str | float) -> Column:
    """A column with a default in place of nulls."""
    return F.coalesce(F.col(column), F.lit(default))


def number_or_null(column: str | Column, data_type: str) -> Column:
    """Text as a number; null where it is none."""
    return (F.col(column) if isinstance(column, str) else column).try_cast(data_type)


def _ordered_items(orders: DataFrame, dedup: bool, *more: str) -> DataFrame:
    known = orders.filter(F.col("id").isNotNull())
    if dedup:
        known = latest_per_key(known, ["id"], _delivery(known))
    return known.select(
        *more,
        F.col("id").cast("string").alias("order_id"),
        F.col("userId").cast("string").alias("customer_id"),
        to_day("date").alias("order_date"),
        "products",
        "status",
    )


def _exploded(orders: DataFrame) -> DataFrame:
    others = [c for c in orders.columns if c != "products"]
    item = F.col("item")
    return orders.select(*others, F.explode("products").alias("item")).select(
        *others,
        item["productId"].cast("string").alias("product_id"),
        item["quantity"].try_cast("int").alias("quantity"),
    )


def order_items(
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    as_of: When = None,
    dedup: bool = False,
) -> DataFrame:
    """``fact_orders``: one row per item with a known product and customer.

    The customer is looked up before the items are unnested, while there is
    still one row per order to move. ``dedup`` takes only the last delivery of
    each order; by default every delivery counts.
    """
    return measured_items(sold_items(orders, products, customers, dedup), as_of)


def sold_items(
    orders: DataFrame, products: DataFrame, customers: DataFrame, dedup: bool = False
) -> DataFrame:
    """What the rows of ``order_items`` are computed from, with the month they are stored
    under. Narrower than the fact, so it is what should be moved."""
    buyers = customers.filter("is_current").select("customer_id", "customer_key")
    goods = products.filter("is_current").select("product_id", "product_key", "price", "category")
    sold = lookup(_ordered_items(orders, dedup), buyers, "customer_id", "inner")
    items = lookup(_exploded(sold), goods, "product_id", "inner")
    return items.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})


def items_by_month(
    orders: DataFrame, products: DataFrame, customers: DataFrame, small: bool
) -> DataFrame:
    """What ``sold_items`` gives, of orders as ``ordered`` gives them, gathered by month
    with the items of an order side by side, which files hold the most of.

    Where the dimensions are ``small`` enough to be sent to all tasks, orders are gathered
    with their items still nested, and nothing is moved after that. Else items are,
    before measures and constants make the rows wide.
    """
    buyers = customers.filter("is_current").select("customer_id", "customer_key")
    goods = products.filter("is_current").select("product_id", "product_key", "price", "category")
    if small:
        sold = lookup(by_month(orders), F.broadcast(buyers), "customer_id", "inner")
        items = lookup(_exploded(sold), F.broadcast(goods), "product_id", "inner")
    else:
        sold = lookup(orders, buyers, "customer_id", "inner")
        items = by_month(lookup(_exploded(sold), goods, "product_id", "inner"))
    return items.sortWithinPartitions(*schemas.PARTITIONING["fact_orders"], "order_id")


def by_month(rows: DataFrame) -> DataFrame:
    """Rows gathered by the month of their order."""
    dated = rows.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    return dated.hint("rebalance", *schemas.PARTITIONING["fact_orders"])


def measured_items(items: DataFrame, as_of: When = None) -> DataFrame:
    """``fact_orders`` from ``sold_items``."""
    revenue, cost, profit = line_metrics(F.col("quantity"), F.col("price"))
    stamped = items.withColumns(
        {
            "revenue": revenue,
            "cost": cost,
            "profit": profit,
            "discount": F.lit(0).cast("decimal(10,2)"),
            "day": F.dayofmonth("order_date"),
            "load_timestamp": run_time(as_of),
        }
    )
    return stamped.select(schemas.FACT_ORDERS.names)


def ordered(orders: DataFrame, dedup: bool = False) -> DataFrame:
    """Orders with typed columns and their items, of every delivery or of the last one."""
    return _ordered_items(orders, dedup)


def delivered_orders(orders: DataFrame, dedup: bool = True) -> DataFrame:
    """The last delivery of each order, or every one, with the day and the file it came in."""
    return _ordered_items(orders, dedup, *_DELIVERY)


def tagged_items(
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    as_of: When = None,
    small: bool = False,
) -> DataFrame:
    """Every item of ``delivered_orders``: columns of the fact, and as ``reason`` why an item
    is none of it, null if it is. Items of unknown products have no price. Dimensions that
    are ``small`` are sent to all tasks."""
    buyers = customers.filter("is_current").select("customer_id", "customer_key")
    goods = products.filter("is_current").select("product_id", "product_key", "price", "category")
    if small:
        buyers, goods = F.broadcast(buyers), F.broadcast(goods)
    items = lookup(_exploded(lookup(orders, buyers, "customer_id")), goods, "product_id")
    revenue, cost, profit = line_metrics(F.col("quantity"), F.col("price"))
    reason = F.when(F.col("product_key").isNull(), "unknown product").when(
        F.col("customer_key").isNull(), "unknown customer"
    )
    tagged = items.withColumns(
        {
            "revenue": revenue,
            "cost": cost,
            "profit": profit,
            "discount": F.lit(0).cast("decimal(10,2)"),
            "year": F.year("order_date"),
            "month": F.month("order_date"),
            "day": F.dayofmonth("order_date"),
            "load_timestamp": run_time(as_of),
            "reason": reason,
        }
    )
    return tagged.select(schemas.REJECTED_ORDERS.names)


def orders_again(rejected: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders kept because of a rejected item that the dimensions now know better, as
    ``delivered_orders`` gave them."""
    open_items = rejected.filter("reason is not null")
    goods = products.filter("is_current").select("product_id")
    buyers = customers.filter("is_current").select("customer_id")
    known = open_items.filter("reason = 'unknown product'").join(goods, "product_id", "left_semi").select("order_id")
    known = known.union(
        open_items.filter("reason = 'unknown customer'").join(buyers, "customer_id", "left_semi").select("order_id")
    )
    whole = rejected.join(known, "order_id", "left_semi")
    item = F.struct(F.col("product_id").cast("long").alias("productId"), F.col("quantity").cast("long").alias("quantity"))
    return whole.groupBy("order_id", "customer_id", "order_date", "status", *_DELIVERY).agg(
        F.collect_list(item).alias("products")
    )


def rejected_items(
    orders: DataFrame, products: DataFrame, customers: DataFrame, dedup: bool = False
) -> DataFrame:
    """Order items that ``order_items`` leaves out, with the reason."""
    buyers = customers.filter("is_current").select("customer_id", F.lit(True).alias("_buyer"))
    goods = products.filter("is_current").select("product_id", F.lit(True).alias("_good"))
    sold = lookup(_ordered_items(orders, dedup), buyers, "customer_id")
    items = lookup(_exploded(sold), goods, "product_id")
    reason = F.when(F.col("_good").isNull(), "unknown product").when(
        F.col("_buyer").isNull(), "unknown customer"
    )
    return (
        items.withColumn("reason", reason).filter(F.col("reason").isNotNull())
        .drop("_buyer", "_good")
    )


def clean_events(bronze: DataFrame, with_delivery: bool = False) -> DataFrame:
    """Typed events, one row per event id; ``with_delivery`` adds where they came from."""
    known = bronze.filter(F.col("event_id").isNotNull())
    one_each = latest_per_key(known, ["event_id"], _delivery(known))
    at = F.try_to_timestamp("timestamp")
    return one_each.select(
        "event_id",
        F.lower(clean_text("event_type")).alias("event_type"),
        at.alias("event_time"),
        F.to_date(at).alias("event_date"),
        F.col("user_id").cast("string").alias("customer_id"),
        "session_id",
        F.col("product_id").cast("string").alias("product_id"),
        "page_url",
        "referrer",
        "device",
        *(_DELIVERY if with_delivery else ()),
    )


def event_counts(events: DataFrame) -> DataFrame:
    """Events per customer and type, with the first and last time: funnel steps."""
    return events.groupBy("customer_id", "event_type").agg(
        F.count("*").alias("events"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
    )
