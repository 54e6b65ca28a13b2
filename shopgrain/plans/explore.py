"""Exploratory views over the bronze tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import to_day, to_number
from ..operators import exact_quantiles, histogram, table_counts, value_counts

DATASETS = ("Products", "Customers", "Orders", "Events")


def raw(tables: Mapping[str, DataFrame], dataset: str) -> DataFrame:
    """A whole bronze table, picked by its display name."""
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset: {dataset}")
    return tables[dataset.lower()]


def has_data(df: DataFrame, *columns: str) -> bool:
    """Whether a view can be drawn: the columns exist and there is a row."""
    return all(c in df.columns for c in columns) and not df.isEmpty()


def kpis(tables: Mapping[str, DataFrame]) -> DataFrame:
    return table_counts(tables)


def _priced(products: DataFrame) -> DataFrame:
    price = to_number(F.col("price"), products.schema["price"].dataType)
    return products.select("category", price.alias("price")).filter(
        F.col("price").isNotNull() & ~F.isnan("price")
    )


def price_stats(products: DataFrame) -> DataFrame:
    """Box-plot figures of the price per category, with 1.5 IQR fences."""
    priced = _priced(products).filter(F.col("category").isNotNull())
    quantiles = {
        "min_price": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max_price": 1.0,
    }
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return exact_quantiles(priced, "price", quantiles, ["category"]).select(
        "*",
        (F.col("q1") - reach).alias("lower_fence"),
        (F.col("q3") + reach).alias("upper_fence"),
    )


def price_histogram(products: DataFrame, bins: int = 20, by_category: bool = False) -> DataFrame:
    return histogram(
        _priced(products), F.col("price"), bins, ["category"] if by_category else []
    )


def single_category(products: DataFrame) -> bool:
    """Whether a histogram is shown in place of one box per category."""
    return len(_priced(products).select("category").distinct().limit(2).take(2)) <= 1


def category_counts(products: DataFrame) -> DataFrame:
    return value_counts(products, "category")


def ratings(products: DataFrame) -> DataFrame:
    """Review count and rate of every product that has both."""
    return products.select("id", "rating.count", "rating.rate").dropna(subset=["count", "rate"])


def city_counts(customers: DataFrame) -> DataFrame:
    """Customers per city; those without an address count as unknown."""
    city = F.when(F.col("address").isNull(), "Unknown").otherwise(F.col("address.city"))
    return value_counts(customers.select(city.alias("city")), "city")


def customer_list(customers: DataFrame) -> DataFrame:
    return customers.select("id", "email", "username")


def status_counts(orders: DataFrame) -> DataFrame:
    return value_counts(orders, "status")


def daily_orders(orders: DataFrame) -> DataFrame:
    return (
        orders.select(to_day("date").alias("date"))
        .filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(F.count("*").alias("count"))
        .orderBy("date")
    )


def event_counts(events: DataFrame) -> DataFrame:
    return value_counts(events, "event_type")


def device_counts(events: DataFrame) -> DataFrame:
    return value_counts(events, "device")


def search(df: DataFrame, column: str, text: str, where: Column | None = None) -> DataFrame:
    """Rows whose column contains a text and that meet a further condition."""
    found = df.filter(F.col(column).contains(text))
    return found if where is None else found.filter(where)


def preview(df: DataFrame, order_by: str, rows: int = 5) -> DataFrame:
    return df.orderBy(order_by).limit(rows)
