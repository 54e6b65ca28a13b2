import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopgrain import schemas
from shopgrain.plans import explore, silver, suites
from shopgrain.plans.lakehouse import build_from_folder
from shopgrain.sinks import (
    export_csv,
    run_summary,
    write_bronze_json,
    write_documents,
    write_events,
    write_table,
)
from shopgrain.sources import (
    attach,
    current_lookup,
    column_list,
    discover,
    discover_all,
    evolve,
    query,
    read_bronze,
    read_day,
    read_documents,
    register,
    schema_changes,
    skipped_documents,
)


def put(path, content, raw=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if raw else json.dumps(content, indent=2))


@pytest.fixture
def bronze(tmp_path):
    """A bronze folder as documents of pretty-printed arrays."""
    products = [
        {"id": 1, "title": "Lamp", "price": 9.99, "category": "home", "rating": {"rate": 4.0, "count": 9}},
        {"id": 2, "title": "Ball", "price": "5", "category": "toys"},
    ]
    put(tmp_path / "products/date=2024-03-01/a.json", products)
    put(tmp_path / "products/date=2024-03-02/b.json", [{**products[1], "price": 6}])
    customer = {
        "id": 7, "email": "x@y.z", "name": {"firstname": "Ann", "lastname": "Lee"},
        "address": {"city": "Rome", "geolocation": {"lat": "1.5", "long": "2.5"}}, "phone": "1-2",
    }
    put(tmp_path / "customers/date=2024-03-01/a.json", [customer])
    orders = [
        {"id": 1, "userId": 7, "date": "2024-02-27", "status": "shipped",
         "products": [{"productId": 1, "quantity": 2}, {"productId": 2, "quantity": 1}]},
        {"id": 2, "userId": 8, "date": "2024-02-28", "products": [{"productId": 1, "quantity": 1}]},
    ]
    put(tmp_path / "orders/date=2024-03-01/a.json", orders)
    put(tmp_path / "orders/date=2024-03-01/b.json", [{"id": 3, "userId": 7, "date": "2024-02-29"}])
    event = {"event_id": "e", "event_type": "view", "timestamp": "2024-03-01T01:02:03.000004", "device": "tablet"}
    put(tmp_path / "events/year=2024/month=03/day=01/e.json", [event])
    return tmp_path


def test_orders_keep_their_own_date(spark, bronze):
    orders = read_bronze(spark, f"{bronze}/orders", "orders")
    assert rows(orders, "id", "date", F.col("ingest_date").cast("string")) == [
        (1, "2024-02-27", "2024-03-01"), (2, "2024-02-28", "2024-03-01"), (3, "2024-02-29", "2024-03-01"),
    ]


def test_other_bronze_tables(spark, bronze):
    products = read_bronze(spark, f"{bronze}/products", "products")
    assert rows(products, "id", "price") == [(1, "9.99"), (2, "5"), (2, "6")]
    people = read_bronze(spark, f"{bronze}/customers", "customers")
    assert rows(people, "id", "address.country", "address.geolocation.lat") == [(7, None, "1.5")]
    events = silver.clean_events(read_bronze(spark, f"{bronze}/events", "events"))
    assert rows(events, "event_id", F.date_format("event_time", "HH:mm:ss.SSSSSS"), "device") == [
        ("e", "01:02:03.000004", "tablet")
    ]
    day = read_bronze(spark, f"{bronze}/events", "events").select(F.col("ingest_date").cast("string"))
    assert rows(day) == [("2024-03-01",)]


def test_folder_to_gold(spark, bronze, tmp_path):
    house = build_from_folder(spark, str(bronze), str(tmp_path / "lake"))
    fact = rows(house.table("fact_orders"), "order_id", "product_id", F.col("revenue").cast("double"))
    assert fact == [("1", "1", 19.98), ("1", "2", 6.0)]
    assert house.table("dim_date").count() == 1
    assert rows(house.table("customer_360"), "customer_id", "total_orders") == [("7", 1)]
    lookup = current_lookup(house.table("dim_products"), "product_id", "category")
    assert rows(lookup) == [("1", "HOME"), ("2", "TOYS")]


def test_one_day(spark, bronze):
    assert read_day(spark, str(bronze), "orders", "2024-03-01").count() == 3
    first = read_day(spark, str(bronze), "orders", "2024-03-01", scope="first_file")
    assert rows(first, "id") == [(1,), (2,)]
    assert read_day(spark, str(bronze), "orders", "2020-01-01").count() == 0
    with pytest.raises(ValueError):
        read_day(spark, str(bronze), "orders", "2024-03-01", scope="some")


def test_tolerant_reader(spark, tmp_path):
    put(tmp_path / "in/list.json", [{"id": 1, "title": "a"}, {"id": "x", "title": "b"}])
    put(tmp_path / "in/deep/dict.json", {"id": 3, "title": "c"})
    put(tmp_path / "in/bad.json", '[{"id": 4, "title": "d"}, {"id": ', raw=True)
    put(tmp_path / "in/notes.csv", '[{"id": 5}]', raw=True)
    put(tmp_path / "in/lines.json", '{"id": 6, "title": "e"}\n{"id": 7, "ti\n{"id": 8, "title": "f"}', raw=True)
    put(tmp_path / "in/line.txt", '[{"id": 9, "title": "g"}, {"id": 10, "title": "h"}]', raw=True)
    schema = schemas.BRONZE_PRODUCTS
    # One bad field costs that field, not the record; a broken file is left out.
    assert rows(read_documents(spark, str(tmp_path / "in"), schema), "id", "title") == [
        (1, "a"), (10, "h"), (3, "c"), (6, "e"), (8, "f"), (9, "g"), (None, "b"),
    ]
    skipped = skipped_documents(spark, str(tmp_path / "in"), schema).collect()
    assert sorted(r.file.rsplit("/", 1)[1] for r in skipped) == ["bad.json", "lines.json"]
    missing = read_documents(spark, str(tmp_path / "none"), schema)
    assert missing.count() == 0 and missing.columns == schema.names
    assert skipped_documents(spark, str(tmp_path / "none"), schema).count() == 0


def test_documents_stay_small(spark, tmp_path):
    df = spark.range(2500).select(
        "id", F.when(F.col("id") < 2000, F.lit("2024-01-01")).when(F.col("id") < 2490, F.lit("2024-01-02"))
        .cast("date").alias("day"),
    )
    write_documents(df, str(tmp_path / "out"), "day", rows_per_document=100)
    files = list((tmp_path / "out").rglob("*.txt"))
    sizes = [len(json.loads(f.read_text())) for f in files]
    assert sum(sizes) == 2500 and max(sizes) <= 100
    back = spark.read.schema("id long").option("multiLine", True).option("recursiveFileLookup", True)
    assert back.json(str(tmp_path / "out")).distinct().count() == 2500
    assert {f.parent.name for f in files} == {
        "date=2024-01-01", "date=2024-01-02", "date=__HIVE_DEFAULT_PARTITION__",
    }


def test_every_layout_of_the_sinks_is_read_back(spark, tmp_path):
    """Lines, arrays and events, a day each; nothing is lost with default arguments."""
    orders = spark.range(50).select("id", F.lit("2024-01-31").alias("date"), F.lit("2024-02-01").cast("date").alias("day"))
    write_bronze_json(orders.drop("day"), str(tmp_path / "orders"), F.lit("2024-02-01").cast("date"))
    write_documents(orders, str(tmp_path / "products"), "day", rows_per_document=7)
    events = spark.range(30).select(F.col("id").cast("string").alias("event_id"))
    write_events(events, str(tmp_path / "events"), F.lit("2024-02-01").cast("date"))
    for table, n in (("orders", 50), ("products", 50), ("events", 30)):
        found = read_bronze(spark, str(tmp_path / table), table)
        assert found.count() == n
        assert rows(found.select(F.col("ingest_date").cast("string")).distinct()) == [("2024-02-01",)]
        assert read_day(spark, str(tmp_path), table, "2024-02-01").count() == n
        assert read_day(spark, str(tmp_path), table, "2024-02-02").count() == 0


def test_unknown_layouts_are_an_error(spark, tmp_path):
    put(tmp_path / "orders/day-1/a.json", [{"id": 1}])
    with pytest.raises(ValueError, match="no day folders"):
        read_day(spark, str(tmp_path), "orders", "2024-03-01")
    assert read_day(spark, str(tmp_path), "products", "2024-03-01").count() == 0
    with pytest.raises(ValueError):
        suites.check_day(spark, str(tmp_path), "2024-03-01", "r", str(tmp_path / "dq"), "2024-03-01 00:00:00")


def test_empty_folder_values_are_null(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, "007"), (3, None)], "id int, c string")
    write_table(df, str(tmp_path / "t"), ["c"])
    back = spark.read.schema("id int, c string").parquet(str(tmp_path / "t"))
    assert rows(back) == [(1, None), (2, "007"), (3, None)]


def test_static_rebuild_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, c string"), path, ["c"])
    moved = spark.createDataFrame([(1, "b"), (2, "b")], "id int, c string")
    write_table(moved, path, ["c"])
    assert rows(spark.read.parquet(path)) == [(1, "b"), (2, "b")]
    write_table(spark.createDataFrame([(3, "a")], "id int, c string"), path, ["c"], incremental=True)
    assert rows(spark.read.parquet(path)) == [(1, "b"), (2, "b"), (3, "a")]


def test_json_sinks_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-05"), (2, "2024-11-30")], "id int, at string")
    write_bronze_json(df, str(tmp_path / "j"), F.to_date("at"))
    assert {p.parent.name for p in (tmp_path / "j").rglob("*.json")} == {
        "ingest_date=2024-01-05", "ingest_date=2024-11-30",
    }
    write_events(df, str(tmp_path / "e"), F.to_date("at"))
    assert (tmp_path / "e/year=2024/month=01/day=05").is_dir()
    export_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2


def test_run_summary(spark):
    found = run_summary({"t": (spark.range(10), spark.range(7)), "u": (spark.range(0), spark.range(0))})
    assert rows(found) == [("t", 10, 7, 3), ("u", 0, 0, 0)]


def test_discovery(spark, tmp_path):
    put(tmp_path / "1/a.json", [{"id": 1, "old": "x"}])
    put(tmp_path / "2/a.json", [{"id": 2, "new": {"deep": True}}])
    found = evolve([discover(spark, str(tmp_path / n)) for n in "12"])
    assert rows(found, "id", "old", "new.deep") == [(1, "x", None), (2, None, True)]
    third = spark.createDataFrame([("3", 1.5)], "id string, old double")
    assert schema_changes(found.schema, third.schema) == {
        "added": [], "missing": ["new"], "retyped": ["id", "old"],
    }
    assert rows(evolve([found, third]), "id", "old") == [("1", "x"), ("2", None), ("3", "1.5")]
    put(tmp_path / "all/orders/date=2024-03-01/a.json", [{"id": 1, "date": "2024-02-01"}])
    put(tmp_path / "all/orders/date=2024-03-02/b.json", '{"id": 2}\n{"id": 3, "x": 1}\n{"id": 4, "x', raw=True)
    put(tmp_path / "all/people/c.json", {"name": "n"})
    tables = discover_all(spark, str(tmp_path / "all"))
    assert rows(tables["orders"], "id", "date", "folder_date", "x") == [
        (1, "2024-02-01", "2024-03-01", None), (2, None, "2024-03-02", None), (3, None, "2024-03-02", 1),
    ]
    assert rows(column_list(spark, {"people": tables["people"]})) == [("people", 0, "name", "string")]
    listed = spark.createDataFrame([(4, [1])], "id long, new array<int>")
    assert rows(evolve([found, listed]), "id", "new") == [(1, None), (2, '{"deep":true}'), (4, "[1]")]
    register(spark, {"found": found})
    assert rows(query(spark, "select count(*) from found")) == [(2,)]
    assert rows(query(spark, "select max(id) from {f}", f=found)) == [(2,)]


def test_attached_tables(spark, tmp_path):
    write_table(spark.range(5), str(tmp_path / "t"))
    attach(spark, {"attached_numbers": str(tmp_path / "t")})
    assert rows(query(spark, "select sum(id) from attached_numbers")) == [(10,)]
    spark.sql("drop table attached_numbers")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_explore_guards(spark):
    products = spark.createDataFrame(
        [(1, "1.5", "a", (None, 3)), (2, "x", "a", (4.0, 2))],
        "id long, price string, category string, rating struct<rate: double, count: long>",
    )
    assert explore.has_data(products, "price") and not explore.has_data(products, "absent")
    assert not explore.has_data(products.filter("false"), "price")
    assert explore.single_category(products)
    assert rows(explore.ratings(products)) == [(2, 2, 4.0)]
    assert rows(explore.price_stats(products), "n", "median") == [(1, 1.5)]
    with pytest.raises(ValueError):
        explore.raw({}, "Nothing")
    people = spark.createDataFrame(
        [(None,), (("Rome",),), ((None,),)], "address struct<city: string>"
    )
    assert rows(explore.city_counts(people)) == [("Rome", 1), ("Unknown", 1)]
