"""What the plans must look like to hold on big and uneven tables."""

import pytest
from pyspark.sql import functions as F

from shopgrain import scratch
from shopgrain.operators import nest_items
from shopgrain.plans import gold, lakehouse, silver
from shopgrain.registry.common import LOAD_TIME, lake
from shopgrain.session import fitted_shuffles
from shopgrain.sinks import write_table
from shopgrain.sources import warehouse


def executed(df):
    """The physical plan after a run, without the initial plan below it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def settings(spark):
    """Change settings for one test only."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def house(spark, folder):
    return lake(spark, folder)


def test_hot_keys_are_split_in_joins(spark, settings):
    """A third of the orders has one customer, a third of the items one product."""
    folder = "/root/testdata/sf0.01"
    house = lake(spark, folder)
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__files__maxPartitionBytes="64k",
        spark__sql__files__openCostInBytes="1k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
    )
    hot = F.array(F.struct(F.lit(3).cast("long").alias("productId"), F.lit(1).cast("long").alias("quantity")))
    orders = warehouse.orders(spark, folder).withColumns(
        {
            "userId": F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("userId")),
            "products": F.when(F.col("id") % 5 < 2, hot).otherwise(F.col("products")),
        }
    )
    fact = silver.order_items(
        orders, house.table("dim_products"), house.table("dim_customers"), LOAD_TIME
    ).hint("rebalance", "year", "month")
    plan = executed(fact)
    assert plan.count("SortMergeJoin(skew=true)") == 2


def test_dimension_is_pruned_and_filtered_in_the_scan(house):
    products = house.table("dim_products").filter("is_current").select("product_id", "price")
    plan = executed(products)
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in plan
    assert "ReadSchema: struct<product_id:string,price:decimal(10,2),is_current:boolean>" in plan


def test_months_are_pruned(house):
    fact = house.table("fact_orders").filter("year = 1996 and month = 2")
    plan = executed(fact.select("revenue"))
    assert "PartitionFilters: [isnotnull(year" in plan


def test_fact_scans_read_only_what_they_need(house):
    plan = executed(gold.cohort_analysis(house.table("fact_orders"), LOAD_TIME))
    assert "ReadSchema: struct<order_date:date,customer_id:string,revenue:decimal(10,2)>" in plan
    assert "Join" not in plan


def test_cohort_window_sees_reduced_rows(house):
    """The window comes after both halves of the aggregation, never before."""
    plan = executed(gold.cohort_analysis(house.table("fact_orders"), LOAD_TIME))
    assert plan.index("Window") < plan.rindex("partial_sum")


def test_distinct_counts_do_not_repeat_rows(house, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = executed(gold.product_totals(house.table("fact_orders")))
    assert "Expand" not in plan
    # Every branch leaves its last exchange by group, so the joins need no other.
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 5


def test_a_hot_folder_gets_several_files(spark, tmp_path, settings):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__files__maxPartitionBytes="64k",
    )
    rows = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 30).otherwise(1).alias("c"), F.sha2(F.col("id").cast("string"), 256)
        .alias("v")
    )
    path = str(tmp_path / "t")
    write_table(rows, path, ["c"])
    files = spark.read.parquet(path).inputFiles()
    assert sum("/c=1/" in f for f in files) > 1
    assert spark.read.parquet(path).count() == 60_000


def test_nesting_without_big_keys_takes_one_shuffle(spark):
    items = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    plan = executed(nest_items(items, ["k"], {"id": F.col("id")}, "ids"))
    assert plan.count("Exchange") == 1


def test_shuffles_are_fitted_to_the_input(spark, folder, settings):
    settings(spark__sql__shuffle__partitions="8")
    key = "spark.sql.shuffle.partitions"
    with fitted_shuffles(spark, [folder]) as n:
        assert n == 8
    with fitted_shuffles(spark, [folder, folder + "/none"], bytes_per_partition=1_000) as n:
        assert n > 500 and spark.conf.get(key) == str(n)
    assert spark.conf.get(key) == "8"


def test_partitions_are_merged_to_what_a_task_can_sort(spark, settings):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for said, inside in (("256m", str(32 << 20)), ("16k", str(16 << 10))):
        settings(spark__sql__adaptive__advisoryPartitionSizeInBytes=said)
        with fitted_shuffles(spark, []):
            assert spark.conf.get(key) == inside
        assert spark.conf.get(key) == said


def test_fact_is_gathered_by_month_before_it_is_wide(spark, folder, tmp_path, monkeypatch):
    """One rebalance by month, of rows without measures and constants."""
    written = {}
    monkeypatch.setattr(lakehouse, "write_table", lambda df, path, *a, **k: (written.update({path: df}), write_table(df, path, *a, **k)))
    house = lakehouse.Lakehouse(spark, str(tmp_path))
    bronze = {n: f(spark, folder) for n, f in (("products", warehouse.products), ("customers", warehouse.customers), ("orders", warehouse.orders))}
    house.build_silver(bronze, LOAD_TIME)
    plan = written[house.path("fact_orders")]._jdf.queryExecution().optimizedPlan()
    gathered = [plan]
    while gathered[-1].nodeName() != "RebalancePartitions":
        gathered.append(gathered[-1].children().head())
    names = gathered[-1].output().mkString(",")
    assert "order_date" in names and not any(n in names for n in ("revenue", "profit", "load_timestamp"))
    wanted = silver.order_items(bronze["orders"], house.table("dim_products"), house.table("dim_customers"), LOAD_TIME)
    assert house.table("fact_orders").exceptAll(wanted).isEmpty() and house.table("fact_orders").count() == wanted.count()


def test_silver_is_built_from_small_scans(spark, folder, tmp_path, monkeypatch):
    key, seen = "spark.sql.files.maxPartitionBytes", set()
    before = spark.conf.get(key)
    monkeypatch.setattr(lakehouse, "write_table", lambda df, *a, **k: (seen.add(spark.conf.get(key)), write_table(df, *a, **k)))
    lakehouse.Lakehouse(spark, str(tmp_path)).build_silver(warehouse.bronze(spark, folder), LOAD_TIME)
    assert seen == {str(32 << 20)} and spark.conf.get(key) == before


def test_items_of_an_order_are_neighbours_in_files(house):
    stored = house.table("fact_orders").select("order_id", F.input_file_name().alias("file"))
    files = {}
    for row in stored.collect():
        files.setdefault(row["file"], []).append(row["order_id"])
    assert files and all(ids == sorted(ids) for ids in files.values())


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError):
        scratch._root(Session)


def test_ranking_runs_no_job_before_it_is_asked(spark, house):
    status = spark.sparkContext.statusTracker()
    before = len(status.getJobIdsForGroup(None))
    gold.product_performance(house.table("fact_orders"), house.table("dim_products"), LOAD_TIME)
    assert len(status.getJobIdsForGroup(None)) == before


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch.new_path(spark, "x")
    assert path != scratch.new_path(spark, "x")
    if shared:
        assert path.startswith(shared)


def test_orders_are_gathered_with_their_items_nested(spark, folder, tmp_path):
    """Where dimensions are small, orders move and their items do not."""
    house = lakehouse.Lakehouse(spark, str(tmp_path))
    house.build_dimensions({n: f(spark, folder) for n, f in (("products", warehouse.products), ("customers", warehouse.customers))})
    goods, people = house.table("dim_products"), house.table("dim_customers")
    orders = scratch.materialize(silver.ordered(warehouse.orders(spark, folder)), "orders")
    assert house.small("dim_products", "dim_customers")
    found = []
    for small in (True, False):
        items = silver.items_by_month(orders, goods, people, small)
        text = items._jdf.queryExecution().optimizedPlan().toString()
        assert (text.index("Generate explode") < text.index("RebalancePartitions")) is small
        found.append(silver.measured_items(items, LOAD_TIME))
    assert executed(found[0]).count("Exchange hashpartitioning") == 1
    assert found[0].exceptAll(found[1]).isEmpty() and found[0].count() == found[1].count() > 0


def test_shuffle_files_go_with_their_job(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    groups = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with fitted_shuffles(spark, []):
        assert spark.conf.get(key) == "true"
        # A frame that is asked again finds its shuffle gone, and makes it anew.
        assert sorted(groups.collect()) == sorted(groups.collect())
    assert spark.conf.get(key) == before and groups.count() == 7
