"""Readers for silver and gold Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas

# Declared schemas spare the footer read that schema inference costs; the
# partition columns they name keep their declared types, so a category "007" stays
# text.
_DECLARED = {
    "dim_products": schemas.DIM_PRODUCTS,
    "dim_customers": schemas.DIM_CUSTOMERS,
    "fact_orders": schemas.FACT_ORDERS,
    "rejected_orders": schemas.REJECTED_ORDERS,
    "dim_date": schemas.DIM_DATE,
    "events": schemas.EVENTS,
    "daily_sales_summary": schemas.DAILY_SALES,
    "product_performance": schemas.PRODUCT_PERFORMANCE,
    "customer_360": schemas.CUSTOMER_360,
    "category_analysis": schemas.CATEGORY_ANALYSIS,
    "cohort_analysis": schemas.COHORT_ANALYSIS,
    "pair_months": schemas.PAIR_MONTHS,
    "customer_months": schemas.CUSTOMER_MONTHS,
    "customer_totals": schemas.CUSTOMER_TOTALS,
    "product_totals": schemas.PRODUCT_TOTALS,
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    reader = spark.read
    if name in _DECLARED:
        schema = _DECLARED[name]
        return reader.schema(schema).parquet(f"{root.rstrip('/')}/{name}").select(schema.names)
    return reader.parquet(f"{root.rstrip('/')}/{name}")


def current_lookup(dimension: DataFrame, *columns: str) -> DataFrame:
    """The current rows of a dimension, cut down to the columns a join needs."""
    return dimension.filter("is_current").select(*columns)
