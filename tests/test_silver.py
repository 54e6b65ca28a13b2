import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopgrain import schemas
from shopgrain.operators import explode_items, latest_per_key, lookup, nest_items
from shopgrain.plans import silver

AS_OF = "2024-03-01 08:00:00"


def bronze(spark, table, records):
    schema = StructType(list(schemas.BRONZE[table]))
    schema = schema.add("ingest_date", "string").add("source_file", "string")
    full = [{**{f: None for f in schema.names}, "ingest_date": "2024-01-01", "source_file": "a", **r}
            for r in records]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="module")
def products(spark):
    return silver.clean_products(
        bronze(
            spark,
            "products",
            [
                {"id": 1, "title": " Lamp ", "price": "5", "category": " toys "},
                {"id": 1, "title": "Lamp", "price": "9.99", "category": "home", "ingest_date": "2024-01-02",
                 "rating": (4.5, 12)},
                {"id": 1, "title": "Lamp", "price": "-1", "ingest_date": "2024-01-03"},
                {"id": None, "title": "ghost", "price": "1"},
                {"id": 2, "title": "zero", "price": "0"},
                {"id": 3, "title": "none", "price": None},
                {"id": 4, "title": "text", "price": "abc"},
                {"id": 5, "title": "Ball", "price": "10.005", "category": " toys "},
            ],
        ),
        AS_OF,
    )


@pytest.fixture(scope="module")
def customers(spark):
    return silver.clean_customers(
        bronze(
            spark,
            "customers",
            [
                {"id": 10, "email": "A@x.com", "name": ("Ann", "Lee"), "phone": "(12) 3-4"},
                {"id": 10, "email": "a@x.com ", "name": (None, "Lee"), "ingest_date": "2024-01-02",
                 "phone": "5-6", "address": ("Rome", " Via ", 1, " 00100 ", None, " it ")},
                {"id": 11, "email": "b@x.com", "name": (" Bob ", "Ray")},
                {"id": 11, "email": "bob@x.com", "name": (" Bob ", "Ray"), "source_file": "b"},
                {"id": 12, "email": None},
                {"id": None, "email": "c@x.com"},
                {"id": None, "email": "d@x.com"},
            ],
        ),
        AS_OF,
    )


def test_products(products):
    assert products.columns == schemas.DIM_PRODUCTS.names
    found = rows(
        products, "product_id", "product_name", "category", "price", "rating", "review_count"
    )
    assert found == [
        ("1", "Lamp", "HOME", Decimal("9.99"), Decimal("4.50"), 12),
        ("5", "Ball", "TOYS", Decimal("10.01"), Decimal("0.00"), 0),
    ]
    stamp = products.select("effective_date", "expiration_date", "is_current").distinct()
    assert rows(stamp) == [(dt.date(2024, 3, 1), dt.date(2099, 12, 31), True)]


def test_customers_have_one_current_row(customers):
    assert customers.columns == schemas.DIM_CUSTOMERS.names
    found = rows(customers, "customer_id", "full_name", "email", "phone", "country", "segment")
    assert found == [
        ("10", "Lee", "a@x.com", "56", "IT", "VIP"),
        ("11", "Bob Ray", "bob@x.com", None, "US", "NEW"),
        (None, "", "c@x.com", None, "US", "NEW"),
        (None, "", "d@x.com", None, "US", "NEW"),
    ]
    assert customers.select("customer_key").distinct().count() == 4
    assert rows(customers.filter("customer_id = 10"), "street", "city", "zipcode") == [
        ("Via", "Rome", "00100")
    ]


def test_raw_emails_stay_apart(spark):
    people = bronze(spark, "customers", [{"id": 1, "email": "A@x"}, {"id": 2, "email": "a@x "}])
    assert silver.one_per_email(people).count() == 1
    assert silver.one_per_email(people, normalise=False).count() == 2


def test_keys_do_not_change_between_runs(products):
    again = products.repartition(7)
    assert rows(products, "product_id", "product_key") == rows(again, "product_id", "product_key")


ORDERS = [
    {"id": 1, "userId": 10, "date": "2024-02-29", "products": [(1, 2), (1, 1)], "status": "shipped",
     "ingest_date": "2024-03-01"},
    {"id": 2, "userId": 10, "date": "2024-02-29", "products": None},
    {"id": 3, "userId": 10, "date": "2024-02-29", "products": []},
    {"id": 4, "userId": 99, "date": "2024-02-29", "products": [(1, 1)]},
    {"id": 5, "userId": 10, "date": "2024-02-29", "products": [(77, 1)]},
    {"id": 6, "userId": 11, "date": "not a date", "products": [(5, 1)]},
    {"id": None, "userId": 11, "date": "2024-02-29", "products": [(5, 1)]},
    {"id": 7, "userId": 11, "date": "2024-02-28", "products": [(5, 3)], "source_file": "a"},
    {"id": 7, "userId": 11, "date": "2024-02-28", "products": [(5, 3)], "source_file": "b"},
]


def test_order_items(spark, products, customers):
    orders = bronze(spark, "orders", ORDERS)
    fact = silver.order_items(orders, products, customers, AS_OF)
    assert fact.columns == schemas.FACT_ORDERS.names
    assert dict(fact.dtypes) == {f.name: f.dataType.simpleString() for f in schemas.FACT_ORDERS}
    leap, before = dt.date(2024, 2, 29), dt.date(2024, 2, 28)
    assert rows(fact, "order_id", "order_date", "product_id", "quantity", "revenue", "cost", "profit") == [
        ("1", leap, "1", 1, Decimal("9.99"), Decimal("5.99"), Decimal("4.00")),
        ("1", leap, "1", 2, Decimal("19.98"), Decimal("11.99"), Decimal("7.99")),
        ("6", None, "5", 1, Decimal("10.01"), Decimal("6.01"), Decimal("4.00")),
        ("7", before, "5", 3, Decimal("30.03"), Decimal("18.02"), Decimal("12.01")),
        ("7", before, "5", 3, Decimal("30.03"), Decimal("18.02"), Decimal("12.01")),
    ]
    once = silver.order_items(orders, products, customers, AS_OF, dedup=True)
    assert rows(once.filter("order_id in (1, 7)"), "order_id", "status") == [
        ("1", "shipped"), ("1", "shipped"), ("7", None),
    ]
    assert fact.filter("revenue <> cost + profit").count() == 0


def test_rejected_items(spark, products, customers):
    orders = bronze(spark, "orders", ORDERS)
    assert rows(silver.rejected_items(orders, products, customers), "order_id", "reason") == [
        ("4", "unknown customer"), ("5", "unknown product"),
    ]


def test_calendar(spark):
    days = silver.date_dimension(spark, "2022-12-31", "2024-12-31")
    assert dict(days.dtypes) == {f.name: f.dataType.simpleString() for f in schemas.DIM_DATE}
    assert days.count() == 732
    picked = days.filter("date in ('2023-01-01', '2024-02-29', '2024-12-31')")
    assert rows(picked, "date_key", "week", "day_of_week", "day_name", "is_weekend", "quarter") == [
        (20230101, 52, 7, "Sunday", True, 1),
        (20240229, 9, 4, "Thursday", False, 1),
        (20241231, 1, 2, "Tuesday", False, 4),
    ]
    with pytest.raises(ValueError):
        silver.date_dimension(spark)


def test_calendar_spans_the_orders(spark):
    orders = spark.createDataFrame([("2024-02-27",), ("2024-03-01",), (None,)], "day string")
    days = silver.date_dimension(spark, days_of=F.to_date("day"), orders=orders)
    assert days.count() == 4


def test_latest_per_key_with_many_copies(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, 1).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("at"),
        F.lit("x").alias("payload"),
    )
    kept = latest_per_key(df, ["k"], ["at"])
    assert kept.columns == ["k", "at", "payload"]
    assert kept.count() == 501
    assert kept.filter("k = 1").first().at == 2499


def test_nest_and_explode_keep_all_items(spark):
    # One order holds half of all items, a third of them equal.
    items = spark.range(600).select(
        F.when(F.col("id") < 300, 1).otherwise(F.col("id")).alias("order"),
        F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 17).alias("productId"),
        F.lit(2).alias("quantity"),
    )
    fields = {"productId": F.col("productId"), "quantity": F.col("quantity")}
    nested = nest_items(items, ["order"], fields, "items")
    assert nested.columns == ["order", "items"] and nested.count() == 301
    back = explode_items(nested, "items", {"productId": "productId", "quantity": "quantity"})
    assert rows(back) == rows(items)


def test_lookup_takes_left_and_inner(spark):
    with pytest.raises(ValueError):
        lookup(spark.range(1), spark.range(1), "id", "right")
