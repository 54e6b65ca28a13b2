import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopgrain import schemas, scratch
from shopgrain.operators import group_totals
from shopgrain.plans import gold, silver
from shopgrain.plans.lakehouse import GOLD, SILVER, Lakehouse
from shopgrain.registry.common import AS_OF, CALENDAR, LOAD_TIME, THRESHOLDS
from shopgrain.sources import warehouse

DAY = dt.date


def fact_of(spark, items):
    """(order, day, customer, product, category, quantity, revenue) rows as a fact."""
    df = spark.createDataFrame(
        items,
        "order_id string, order_date date, customer_id string, product_id string, "
        "category string, quantity int, revenue decimal(10,2)",
    )
    cost = (F.col("revenue") * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(10,2)")
    return df.withColumns(
        {
            "cost": cost,
            "profit": (F.col("revenue") - cost).cast("decimal(10,2)"),
            "year": F.year("order_date"),
            "month": F.month("order_date"),
        }
    )


@pytest.fixture(scope="module")
def fact(spark):
    m = Decimal
    return fact_of(
        spark,
        [
            ("o1", DAY(2023, 12, 31), "c1", "p1", "A", 2, m("20.00")),
            ("o1", DAY(2023, 12, 31), "c1", "p2", "B", 1, m("5.00")),
            ("o2", DAY(2024, 1, 1), "c1", "p1", "A", 1, m("10.00")),
            ("o3", DAY(2024, 1, 1), "c2", "p1", "A", 1, m("10.00")),
            ("o4", DAY(2024, 3, 1), "c2", "p3", "A", 1, m("40.00")),
            ("o5", DAY(2024, 3, 2), "c3", "p4", "B", 1, m("0.00")),
        ],
    )


def test_daily_sales(spark, fact):
    calendar = silver.date_dimension(spark, "2024-01-01", "2024-12-31")
    sales = gold.daily_sales(fact, calendar, "2024-04-01")
    columns = ["order_date", "date_key", "total_revenue", "profit_margin", "total_orders",
               "total_items", "avg_order_value", "avg_items_per_order"]
    found = rows(sales, *columns)
    # No calendar row for 2023, no margin without revenue.
    assert found[0] == (
        DAY(2023, 12, 31), None, Decimal("25.00"), Decimal("40.00"), 1, 2, Decimal("12.500000"), 2.0,
    )
    assert found[1][:6] == (DAY(2024, 1, 1), 20240101, Decimal("20.00"), Decimal("40.00"), 2, 2)
    assert found[3][2:4] == (Decimal("0.00"), None)


def test_product_performance(spark, fact):
    products = spark.createDataFrame(
        [("p1", "One", Decimal("10.00"), Decimal("4.00"), True),
         ("p1", "Old", Decimal("9.00"), Decimal("4.00"), False),
         ("p3", "Three", Decimal("40.00"), Decimal("1.00"), True)],
        "product_id string, product_name string, price decimal(10,2), rating decimal(3,2), "
        "is_current boolean",
    )
    found = gold.product_performance(fact, products, "2024-04-01")
    assert rows(found, "product_id", "product_name", "revenue_rank_overall", "revenue_rank_in_category") == [
        ("p1", "One", 1, 1), ("p2", None, 2, 1), ("p3", "Three", 1, 1), ("p4", None, 3, 2),
    ]
    assert rows(found.filter("product_id = 'p4'"), "profit_margin", "avg_revenue_per_unit") == [
        (None, Decimal("0.00"))
    ]
    assert rows(gold.top_products(found, 1), "product_id") == [("p1",), ("p3",)]
    assert gold.top_products(found, 1, per_category=True).count() == 3


def customers_of(spark, *ids):
    data = [(i, str(i), f"n{i}", f"{i}@x", "US", "NEW", True, dt.datetime(2024, 4, 1)) for i in ids]
    return spark.createDataFrame(
        data,
        "customer_key long, customer_id string, full_name string, email string, country string, "
        "segment string, is_current boolean, load_timestamp timestamp",
    )


def test_customers_without_orders_stay(spark):
    fact = fact_of(spark, [("o", DAY(2024, 3, 2), "1", "p", "A", 1, Decimal("50.00"))])
    found = gold.customer_360(fact, customers_of(spark, 1, 2), "2024-04-02")
    columns = ["customer_id", "lifetime_revenue", "total_orders", "avg_order_value",
               "days_since_last_order", "days_as_customer", "rfm_score", "customer_segment"]
    assert rows(found, *columns) == [
        ("1", Decimal("50.00"), 1, Decimal("50.000000"), 30, 30, "5-1-2", "Promising"),
        ("2", Decimal("0.00"), 0, Decimal("0.000000"), 9999, 0, "1-1-1", "Hibernating"),
    ]
    assert [tuple(r) for r in gold.segment_distribution(found).collect()] == [
        ("Hibernating", 1), ("Promising", 1),
    ]


def test_cohorts(spark, fact):
    cohorts = gold.cohort_analysis(fact, "2024-04-01")
    columns = ["cohort_period", "months_since_first_purchase", "active_customers",
               "cohort_revenue", "avg_revenue_per_customer"]
    assert rows(cohorts, *columns) == [
        ("2023-12", 0, 1, Decimal("25.00"), Decimal("12.500000")),
        ("2023-12", 1, 1, Decimal("10.00"), Decimal("10.000000")),
        ("2024-1", 0, 1, Decimal("10.00"), Decimal("10.000000")),
        ("2024-1", 2, 1, Decimal("40.00"), Decimal("40.000000")),
        ("2024-3", 0, 1, Decimal("0.00"), Decimal("0.000000")),
    ]
    kept = gold.cohort_retention(cohorts)
    assert kept.filter("retention_percent <> 100").count() == 0


def test_category_growth(spark, fact):
    growth = gold.category_growth(gold.category_analysis(fact, "2024-04-01"))
    assert rows(growth.filter("category = 'A'"), "year", "month", "growth_percent") == [
        (2023, 12, None), (2024, 1, Decimal("0.00")), (2024, 3, Decimal("100.00")),
    ]
    assert rows(growth.filter("category = 'B' and year = 2024"), "revenue_change", "growth_percent") == [
        (Decimal("-5.00"), Decimal("-100.00"))
    ]


def test_group_totals_with_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 1, 2), (None, 1, 1), (None, None, 1), (None, None, None)],
        "g string, h int, v int",
    )
    found = group_totals(df, ["g", "h"], {"n": F.count("*"), "s": F.sum("v")}, {"d": "v", "e": "g"})
    assert found.columns == ["g", "h", "n", "s", "d", "e"]
    assert rows(found) == [("a", 1, 2, 3, 2, 1), (None, 1, 1, 1, 1, 0), (None, None, 2, 1, 1, 0)]


def test_rollup_levels_agree(fact):
    totals = gold.daily_category_rollup(fact).groupBy("level").agg(F.sum("total_revenue"))
    assert rows(totals) == [(0, Decimal("85.00")), (1, Decimal("85.00")), (3, Decimal("85.00"))]


def test_lifetime_value(spark):
    fact = fact_of(spark, [("o", DAY(2024, 3, 2), "1", "p", "A", 1, Decimal("50.00"))])
    people = customers_of(spark, 1, 2).withColumn("lifetime_value", F.lit(0).cast("decimal(10,2)"))
    filled = gold.with_lifetime_value(people, fact)
    assert filled.columns == people.columns
    assert rows(filled, "customer_id", "lifetime_value") == [
        ("1", Decimal("50.00")), ("2", Decimal("0.00")),
    ]


@pytest.fixture(scope="module")
def house(spark, folder):
    house = Lakehouse(spark, scratch.new_path(spark, "test-lake"))
    house.build_silver(warehouse.bronze(spark, folder), LOAD_TIME, CALENDAR)
    house.build_gold(LOAD_TIME, THRESHOLDS, AS_OF)
    return house


def test_totals_agree_between_tables(house):
    measures = {
        "fact_orders": "revenue",
        "daily_sales_summary": "total_revenue",
        "product_performance": "total_revenue",
        "customer_360": "lifetime_revenue",
        "category_analysis": "total_revenue",
        "cohort_analysis": "cohort_revenue",
    }
    totals = {house.table(t).agg(F.sum(m)).first()[0] for t, m in measures.items()}
    assert len(totals) == 1


def test_every_month_of_a_cohort_is_within_its_size(house):
    cohorts = house.table("cohort_analysis")
    assert gold.cohort_retention(cohorts).filter("active_customers > cohort_size").count() == 0
    first = cohorts.filter("months_since_first_purchase = 0").agg(F.sum("active_customers"))
    buyers = house.table("fact_orders").select("customer_id").distinct().count()
    assert first.first()[0] == buyers


def test_rebuild_gives_the_same_tables(spark, folder, house):
    before = {t: sorted(map(str, house.table(t).collect())) for t in SILVER + GOLD}
    house.build_silver(warehouse.bronze(spark, folder), LOAD_TIME, CALENDAR)
    house.build_gold(LOAD_TIME, THRESHOLDS, AS_OF)
    for t in SILVER + GOLD:
        assert sorted(map(str, house.table(t).collect())) == before[t], t


def test_stored_folders(house):
    files = house.table("fact_orders").inputFiles()
    assert all("/year=" in f and "/month=" in f and f.endswith("snappy.parquet") for f in files)
    assert schemas.PARTITIONING["customer_360"] == ("country",)
