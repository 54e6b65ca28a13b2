"""Sessions, funnels, versions by day, kept numbers and several ranks in one pass."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopgrain.operators import assign_keys, dense_ranks, numbered, open_versions, valid_on
from shopgrain.plans.behaviour import event_funnel, event_sessions, funnel_counts, in_sessions
from shopgrain.plans.lakehouse import Lakehouse

STEPS = ("view", "cart", "buy")
START = dt.datetime(2024, 1, 1)


def made_events(spark):
    rng = random.Random(4)
    data = []
    for k in range(1200):
        at = START + dt.timedelta(minutes=rng.choice([rng.randint(0, 300), rng.randint(0, 9000)]))
        data.append((f"e{k:05d}", rng.choice([*STEPS, "other", None]), at, rng.choice(["a", "b", "c", "hot", "hot", "hot"]), "web"))
    data += [("n1", "view", START, None, "web"), ("n2", "view", None, "a", "web")]
    return data, spark.createDataFrame(
        data, "event_id string, event_type string, event_time timestamp, customer_id string, device string"
    )


def plain_sessions(data, gap):
    by = defaultdict(list)
    for e in sorted((e for e in data if e[2] and e[3]), key=lambda e: (e[3], e[2], e[0])):
        last = by[e[3]]
        if not last or e[2] - last[-1][-1][2] > dt.timedelta(minutes=gap):
            last.append([])
        last[-1].append(e)
    return {(c, s[0][2]): s for c, found in by.items() for s in found}


@pytest.mark.parametrize("gap", [5, 90])
def test_sessions_and_funnel(spark, gap):
    data, events = made_events(spark)
    expected = plain_sessions(data, gap)
    got = {(r.customer_id, r.start): (r.events, r.kinds, r.seconds) for r in event_sessions(events, gap).collect()}
    assert got == {
        k: (len(s), len({e[1] for e in s if e[1]}), (s[-1][2] - s[0][2]).total_seconds()) for k, s in expected.items()
    }
    tagged = {r.event_id: (r.customer_id, r.session) for r in in_sessions(events, gap).collect()}
    assert tagged == {e[0]: k for k, s in expected.items() for e in s}
    passed = {}
    for key, session in expected.items():
        state = 0
        for e in session:
            state += state < len(STEPS) and e[1] == STEPS[state]
        passed[key] = state
    funnel = event_funnel(events, STEPS, gap)
    assert {(r.customer_id, r.session): r.steps_passed for r in funnel.collect()} == passed
    counts = {r.step: (r.name, r.passed) for r in funnel_counts(funnel, STEPS).collect()}
    assert counts == {
        k: (name, sum(v >= k for v in passed.values())) for k, name in enumerate(("session", *STEPS)) if any(v >= k for v in passed.values())
    }
    assert event_funnel(events.limit(0), STEPS).count() == event_sessions(events.limit(0)).count() == 0


def test_version_on_a_day(spark):
    d = dt.date
    history = spark.createDataFrame(
        [("a", 1, d(2024, 1, 10), d(2024, 2, 1)), ("a", 2, d(2024, 2, 1), d(2099, 12, 31)), ("b", 5, d(2024, 3, 1), d(2024, 3, 5))],
        "id string, price int, effective_date date, expiration_date date",
    )
    facts = spark.createDataFrame(
        [("a", d(2024, 1, 1)), ("a", d(2024, 1, 31)), ("a", d(2024, 2, 1)), ("a", None), ("b", d(2024, 3, 5)), (None, d(2024, 1, 1)), ("c", d(2024, 1, 1))],
        "id string, on date",
    )
    found = valid_on(facts, history, "id", "on", "price")
    shown = ("id", F.col("on").cast("string"), "price")
    assert rows(found, *shown) == rows(
        spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-31", 1), ("a", "2024-02-01", 2), ("a", None, None),
                               ("b", "2024-03-05", None), (None, "2024-01-01", None), ("c", "2024-01-01", None)], "id string, on string, price int")
    )
    strict = valid_on(facts, history, "id", "on", "price", first_before=False)
    assert strict.where("on = '2024-01-01' and price is not null").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_key_numbers_are_unique_and_stay(spark, tmp_path):
    path = str(tmp_path / "keys")
    first = spark.createDataFrame([(f"k{k:04d}", k % 3) for k in range(500)] + [(None, 1)], "a string, b int")
    given = {(r.a, r.b): r.number for r in assign_keys(spark, path, first.union(first)).collect()}
    assert sorted(given.values()) == list(range(1, 502))
    later = first.union(spark.createDataFrame([("a", 0), ("zz", None)], first.schema))
    for _ in range(2):
        again = {(r.a, r.b): r.number for r in assign_keys(spark, path, later).collect()}
        assert again == given | {("a", 0): 502, ("zz", None): 503}
    (tmp_path / "keys" / "load-000000003").mkdir()  # a load that broke
    assert assign_keys(spark, path, later.union(spark.createDataFrame([("b", 1)], first.schema))).agg(F.max("number")).first()[0] == 504
    assert assign_keys(spark, path, first.limit(0)).count() == 0
    assert rows(numbered(spark.range(5).select((-F.col("id")).alias("v")), 0)) == sorted([(-4, 0), (-3, 1), (-2, 2), (-1, 3), (0, 4)], key=lambda r: [(False, str(v)) for v in r])


def test_colliding_surrogate_keys_are_an_error(spark, tmp_path):
    house = Lakehouse(spark, str(tmp_path / "lake"))
    data = spark.createDataFrame([("a", 1), ("b", 1)], "product_id string, category int")
    rows_ = open_versions(data, "product_key", F.lit("same"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    with pytest.raises(ValueError, match="one product_key"):
        house._store_dimension("dim_products", rows_, None)
    assert not house.exists("dim_products")


def test_several_ranks_in_one_pass(spark):
    rng = random.Random(7)
    data = [(k, rng.choice(["x", "y", None]), rng.choice([None, *range(40)])) for k in range(600)]
    df = spark.createDataFrame(data, "id int, kind string, v int").cache()
    got = dense_ranks(df, "v", {"over_all": [], "in_kind": ["kind"]}, ranges=9)
    plain = df.withColumn("over_all", F.dense_rank().over(Window.orderBy(F.desc("v"))).cast("bigint"))
    plain = plain.withColumn("in_kind", F.dense_rank().over(Window.partitionBy("kind").orderBy(F.desc("v"))).cast("bigint"))
    assert rows(got, "id", "over_all", "in_kind") == rows(plain, "id", "over_all", "in_kind")
