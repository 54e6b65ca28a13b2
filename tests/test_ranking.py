import random
import statistics
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopgrain.operators import (
    dense_rank,
    exact_quantiles,
    histogram,
    running_total,
    share_of_total,
    value_counts,
)

random.seed(7)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, another third one group."""
    data = [("a", 50.0)] * 300
    data += [("b", float(random.randint(0, 400))) for _ in range(300)]
    data += [(random.choice(["c", "d", None]), random.choice([None, *map(float, range(30))]))
             for _ in range(300)]
    return data, spark.createDataFrame(data, "g string, v double").repartition(5)


@pytest.mark.parametrize("ranges", [2, 3, 16, 64])
@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("descending", [True, False])
def test_dense_rank_equals_window(skewed, ranges, groups, descending):
    _, df = skewed
    spread = dense_rank(df, "v", "rank", groups, descending, ranges)
    order = F.desc("v") if descending else F.asc("v")
    window = Window.partitionBy(*groups).orderBy(order)
    plain = df.withColumn("rank", F.dense_rank().over(window).cast("bigint"))
    assert rows(spread, "g", "v", "rank") == rows(plain, "g", "v", "rank")


def test_running_total(skewed):
    data, df = skewed
    points = df.groupBy("v").agg(F.count("*").alias("n"))
    found = running_total(points, "v", "n", "upto", ranges=7)
    counts = Counter(v for _, v in data)
    total, expected = 0, {}
    for v in sorted(counts, key=lambda v: (v is not None, v)):
        total += counts[v]
        expected[v] = (total, len(data))
    assert {r.v: (r.upto, r.upto_of) for r in found.collect()} == expected


@pytest.mark.parametrize("ranges", [2, 5, 40])
def test_exact_quantiles(skewed, ranges):
    data, df = skewed
    found = exact_quantiles(df, "v", {"lo": 0.0, "q1": 0.25, "med": 0.5, "hi": 1.0}, ["g"], ranges)
    by_group = defaultdict(list)
    for g, v in data:
        if v is not None:
            by_group[g].append(v)
    assert found.count() == len(by_group)
    for r in found.collect():
        vs = by_group[r.g]
        quartiles = statistics.quantiles(vs, n=4, method="inclusive")
        assert (r.n, r.lo, r.hi) == (len(vs), min(vs), max(vs))
        assert r.q1 == pytest.approx(quartiles[0]) and r.med == pytest.approx(quartiles[1])


def test_quantiles_of_one_value(spark):
    df = spark.createDataFrame([("a", 1.5)], "g string, v double")
    assert rows(exact_quantiles(df, "v", {"q1": 0.25, "q3": 0.75}, ["g"])) == [("a", 1, 1.5, 1.5)]


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert dense_rank(df, "v", "r").count() == 0
    assert exact_quantiles(df, "v", {"q": 0.5}, ["g"]).count() == 0


def test_value_counts_and_share(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("a",), (None,)], "v string")
    counts = value_counts(df, "v")
    assert [tuple(r) for r in counts.collect()] == [("y", 2), ("a", 1), ("x", 1)]
    assert rows(share_of_total(counts), "v", "share") == [("a", 0.25), ("x", 0.25), ("y", 0.5)]


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (9.99,), (10.0,), (None,)], "v double")
    found = histogram(df, F.col("v"), 20)
    assert [(r.bin, r["count"]) for r in found.collect()] == [(1, 1), (2, 1), (20, 2)]
    same = spark.createDataFrame([("a", 3.0), ("a", 3.0), (None, 1.0)], "g string, v double")
    assert rows(histogram(same, F.col("v"), 20, ["g"]), "g", "bin", "count") == [
        ("a", 1, 2), (None, 1, 1),
    ]
