"""Gold layer: business tables over the order-item fact.

Every builder aggregates the fact before it joins a dimension, so joins see one
row per key and a hot key is reduced inside the tasks that read it. The fact is
a stored table: builders with distinct counts read its columns in several passes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (
    RfmThresholds,
    percent,
    ratio,
    rfm_segment,
    run_time,
    threshold_score,
)
from ..operators import dense_ranks, group_totals, lookup, match

When = dt.datetime | str | None


def daily_sales(fact: DataFrame, calendar: DataFrame, as_of: When = None) -> DataFrame:
    """``daily_sales_summary``: totals per order day with calendar attributes.

    ``avg_order_value`` is the average per order item, as its consumers expect.
    """
    daily = group_totals(
        fact,
        ["order_date", "year", "month"],
        {
            "total_revenue": F.sum("revenue"),
            "total_profit": F.sum("profit"),
            "total_cost": F.sum("cost"),
            "total_quantity": F.sum("quantity"),
            "avg_order_value": F.avg("revenue"),
            "total_items": F.count("*"),
        },
        {
            "total_orders": "order_id",
            "unique_customers": "customer_id",
            "unique_products": "product_id",
        },
    )
    days = calendar.select(
        F.col("date").alias("order_date"),
        "date_key",
        "quarter",
        "month_name",
        "day",
        "day_name",
        "is_weekend",
    )
    named = lookup(daily, days, "order_date").withColumns(
        {
            "profit_margin": percent("total_profit", "total_revenue"),
            "avg_items_per_order": ratio("total_items", "total_orders"),
            "load_timestamp": run_time(as_of),
        }
    )
    return named.select(schemas.DAILY_SALES.names)


def product_totals(fact: DataFrame) -> DataFrame:
    """Sales per product."""
    return group_totals(
        fact,
        ["product_id", "category"],
        {
            "total_revenue": F.sum("revenue"),
            "total_profit": F.sum("profit"),
            "total_quantity_sold": F.sum("quantity"),
            "avg_revenue_per_order": F.avg("revenue"),
        },
        {"total_orders": "order_id", "unique_customers": "customer_id"},
    )


def product_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per product, all that the rankings need."""
    return fact.groupBy("product_id", "category").agg(F.sum("revenue").alias("total_revenue"))


def product_performance(
    fact: DataFrame,
    products: DataFrame,
    as_of: When = None,
) -> DataFrame:
    """``product_performance``: totals, ratios and revenue ranks per product.

    Ranks need the revenue only, so they are found on a narrow aggregation of
    their own and looked up by product.
    """
    ranks = ranked_products(product_revenue(fact)).drop("total_revenue")
    return _performance(match(product_totals(fact), ranks, ["product_id", "category"]), products, as_of)


def performance_of(totals: DataFrame, products: DataFrame, as_of: When = None) -> DataFrame:
    """``product_performance`` from stored ``product_totals``, which are read twice."""
    return _performance(ranked_products(totals), products, as_of)


def ranked_products(totals: DataFrame) -> DataFrame:
    """Products with their revenue ranks, over all and in their category."""
    return dense_ranks(
        totals, "total_revenue", {"revenue_rank_overall": [], "revenue_rank_in_category": ["category"]}
    )


def _performance(ranked: DataFrame, products: DataFrame, as_of: When) -> DataFrame:
    goods = products.filter("is_current").select("product_id", "product_name", "price", "rating")
    named = lookup(ranked, goods, "product_id").withColumns(
        {
            "profit_margin": percent("total_profit", "total_revenue"),
            "avg_revenue_per_unit": ratio("total_revenue", "total_quantity_sold"),
            "load_timestamp": run_time(as_of),
        }
    )
    return named.select(schemas.PRODUCT_PERFORMANCE.names)


def top_products(performance: DataFrame, k: int, per_category: bool = False) -> DataFrame:
    """Products of the first ``k`` revenue ranks; equal revenues share a rank."""
    rank = "revenue_rank_in_category" if per_category else "revenue_rank_overall"
    return performance.filter(F.col(rank) <= k)


def customer_totals(fact: DataFrame) -> DataFrame:
    """Purchases per customer."""
    return group_totals(
        fact,
        ["customer_id"],
        {
            "lifetime_revenue": F.sum("revenue"),
            "lifetime_profit": F.sum("profit"),
            "total_items_purchased": F.sum("quantity"),
            "avg_order_value": F.avg("revenue"),
            "last_order_date": F.max("order_date"),
            "first_order_date": F.min("order_date"),
        },
        {"total_orders": "order_id", "unique_products_bought": "product_id"},
    )


def add_rfm(
    df: DataFrame, today: Column, thresholds: RfmThresholds = RfmThresholds()
) -> DataFrame:
    """Recency, frequency and monetary scores and the segment they give.

    Needs ``last_order_date``, ``first_order_date``, ``total_orders`` and
    ``lifetime_revenue``. Fixed values: 9999 days without an order, 0 days as
    a customer.
    """
    since_last = F.coalesce(F.datediff(today, "last_order_date"), F.lit(9999))
    since_first = F.coalesce(F.datediff(today, "first_order_date"), F.lit(0))
    recency, frequency, monetary = (
        F.col(c) for c in ("recency_score", "frequency_score", "monetary_score")
    )
    return (
        df.withColumns(
            {"days_since_last_order": since_last, "days_as_customer": since_first}
        )
        .withColumns(
            {
                "recency_score": threshold_score(
                    F.col("days_since_last_order"), thresholds.recency_days, low_is_good=True
                ),
                "frequency_score": threshold_score(F.col("total_orders"), thresholds.orders),
                "monetary_score": threshold_score(F.col("lifetime_revenue"), thresholds.revenue),
            }
        )
        .withColumns(
            {
                "rfm_score": F.concat_ws("-", recency, frequency, monetary),
                "customer_segment": rfm_segment(recency, frequency, monetary),
            }
        )
    )


def customer_360(
    fact: DataFrame,
    customers: DataFrame,
    as_of: When = None,
    thresholds: RfmThresholds = RfmThresholds(),
    today: dt.date | None = None,
) -> DataFrame:
    """``customer_360``: every current customer with lifetime measures and RFM."""
    return profiles_of(customer_totals(fact), customers, as_of, thresholds, today)


def profiles_of(
    totals: DataFrame,
    customers: DataFrame,
    as_of: When = None,
    thresholds: RfmThresholds = RfmThresholds(),
    today: dt.date | None = None,
) -> DataFrame:
    """``customer_360`` from ``customer_totals``.

    Days are counted up to ``today``, by default the customer row's load time.
    """
    profiles = customers.filter("is_current").select(
        "customer_key", "customer_id", "full_name", "email", "country", "segment", "load_timestamp"
    )
    joined = lookup(profiles, totals, "customer_id")
    measured = joined.na.fill(
        0,
        [
            "lifetime_revenue",
            "lifetime_profit",
            "total_items_purchased",
            "total_orders",
            "unique_products_bought",
            "avg_order_value",
        ],
    )
    until = F.col("load_timestamp") if today is None else F.lit(today)
    scored = add_rfm(measured, until, thresholds)
    return scored.withColumn("load_timestamp", run_time(as_of)).select(schemas.CUSTOMER_360.names)


def segment_distribution(customers_360: DataFrame) -> DataFrame:
    """Customers per RFM segment, most frequent first."""
    return (
        customers_360.groupBy("customer_segment")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "customer_segment")
    )


def category_analysis(fact: DataFrame, as_of: When = None) -> DataFrame:
    """``category_analysis``: totals per category and month."""
    totals = group_totals(
        fact,
        ["category", "year", "month"],
        {
            "total_revenue": F.sum("revenue"),
            "total_profit": F.sum("profit"),
            "total_quantity": F.sum("quantity"),
        },
        {
            "unique_products": "product_id",
            "unique_customers": "customer_id",
            "total_orders": "order_id",
        },
    )
    return totals.select(
        "*",
        percent("total_profit", "total_revenue").alias("profit_margin"),
        ratio("total_revenue", "unique_products").alias("revenue_per_product"),
        run_time(as_of).alias("load_timestamp"),
    )


def cohort_analysis(fact: DataFrame, as_of: When = None) -> DataFrame:
    """``cohort_analysis``: activity by month of first purchase and months since.

    ``avg_revenue_per_customer`` is the average per order item, as its
    consumers expect. Items are reduced to one row per customer and month
    first; the window over a customer then holds that customer's months only,
    and each of these rows is one active customer of its month.
    """
    monthly = fact.groupBy("customer_id", "year", "month").agg(
        F.min("order_date").alias("first_date"),
        F.sum("revenue").alias("revenue"),
        F.count("revenue").alias("priced_items"),
    )
    return cohorts_of(monthly, as_of)


def cohorts_of(monthly: DataFrame, as_of: When = None) -> DataFrame:
    """``cohort_analysis`` from a row for each customer and month, with the first day of
    the customer in it, revenue and number of priced items."""
    first = F.min("first_date").over(Window.partitionBy("customer_id"))
    dated = monthly.filter(F.col("customer_id").isNotNull()).withColumn("first_purchase", first)
    cohorts = dated.select(
        F.year("first_purchase").alias("cohort_year"),
        F.month("first_purchase").alias("cohort_month"),
        (
            (F.col("year") - F.year("first_purchase")) * 12
            + (F.col("month") - F.month("first_purchase"))
        ).alias("months_since_first_purchase"),
        "revenue",
        "priced_items",
    )
    revenue = F.sum("revenue").cast("decimal(20,2)")
    return cohorts.groupBy("cohort_year", "cohort_month", "months_since_first_purchase").agg(
        F.count("*").alias("active_customers"),
        revenue.alias("cohort_revenue"),
        F.try_divide(revenue, F.sum("priced_items").cast("decimal(20,0)"))
        .cast("decimal(14,6)")
        .alias("avg_revenue_per_customer"),
        F.concat_ws("-", "cohort_year", "cohort_month").alias("cohort_period"),
        run_time(as_of).alias("load_timestamp"),
    )


def product_months(fact: DataFrame) -> DataFrame:
    """Revenue and quantity of each product by month."""
    return fact.groupBy("product_id", "category", "year", "month").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("quantity").alias("total_quantity")
    )


def product_growth(fact: DataFrame) -> DataFrame:
    """Revenue change of each product against its previous month with sales."""
    return revenue_growth(product_months(fact), ["product_id", "category"])


def product_mix(fact: DataFrame) -> DataFrame:
    """Each product's share of its category's revenue in a month."""
    months = product_months(fact)
    whole = months.groupBy("category", "year", "month").agg(
        F.sum("total_revenue").alias("category_revenue")
    )
    mixed = match(months, whole, ["category", "year", "month"])
    return mixed.withColumn("revenue_share", percent("total_revenue", "category_revenue"))


def category_growth(categories: DataFrame) -> DataFrame:
    """Revenue change of each category against its previous month with sales."""
    return revenue_growth(categories, ["category"])


def revenue_growth(months: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change of ``total_revenue`` against the previous month that a key has."""
    previous = F.lag("total_revenue").over(Window.partitionBy(*keys).orderBy("year", "month"))
    change = F.col("total_revenue") - F.col("previous_revenue")
    return months.select(
        *keys, "year", "month", "total_revenue", previous.alias("previous_revenue")
    ).select(
        "*",
        change.alias("revenue_change"),
        percent(change, "previous_revenue").alias("growth_percent"),
    )


def cohort_retention(cohorts: DataFrame) -> DataFrame:
    """Share of each cohort's customers that is active in later months."""
    size = F.first("active_customers").over(
        Window.partitionBy("cohort_year", "cohort_month").orderBy("months_since_first_purchase")
    )
    return cohorts.select(
        "cohort_year",
        "cohort_month",
        "months_since_first_purchase",
        "active_customers",
        size.alias("cohort_size"),
    ).withColumn("retention_percent", percent("active_customers", "cohort_size"))


def daily_category_rollup(fact: DataFrame) -> DataFrame:
    """Revenue and items per day and category, per day, and over all.

    Rolled up from the totals per day and category, not from the items.
    """
    finest = fact.groupBy("order_date", "category").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("quantity").alias("quantity"),
        F.count("*").alias("items"),
    )
    return finest.rollup("order_date", "category").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("revenue").cast("decimal(20,2)").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("items").alias("total_items"),
    )


def with_lifetime_value(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Customers with ``lifetime_value`` set to the revenue of their orders."""
    value = fact.groupBy("customer_id").agg(F.sum("revenue").alias("_revenue"))
    filled = F.coalesce(F.col("_revenue"), F.lit(0)).try_cast("decimal(10,2)")
    return lookup(customers, value, "customer_id").select(
        *[filled.alias(c) if c == "lifetime_value" else F.col(c) for c in customers.columns]
    )
