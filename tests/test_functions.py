import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shopgrain.functions import (
    RfmThresholds,
    customer_tier,
    digits_only,
    full_name,
    line_metrics,
    percent,
    ratio,
    rfm_segment,
    threshold_score,
    to_day,
    to_number,
)


def values(spark, kind, *items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}").orderBy("i")


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_text(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee"), ("Ann", None)], "a string, b string")
    assert column(df, full_name(F.col("a"), F.col("b"))) == ["Ann Lee", "Lee", "Ann"]
    assert column(values(spark, "string", "(12) 3-4", None), digits_only("v")) == ["1234", None]


def test_numbers_in_text(spark):
    texts = ["9.99", " 1e3 ", "1_000", ".5", "abc", "1.0d", "0x1p3", "", None, "-inf", "5."]
    found = column(values(spark, "string", *texts), to_number(F.col("v"), StringType()))
    inf = float("-inf")
    assert found == [9.99, 1000.0, 1000.0, 0.5, None, None, None, None, None, inf, 5.0]


def test_days(spark):
    texts = ["2024-02-29", "2024-02-30", "soon", None, "2024-01-05 10:11:12"]
    assert column(values(spark, "string", *texts), to_day("v")) == [
        dt.date(2024, 2, 29), None, None, None, dt.date(2024, 1, 5),
    ]


def test_line_metrics(spark):
    df = spark.createDataFrame(
        [(1, Decimal("0.01")), (3, Decimal("9.99")), (2, Decimal("99999999.99")), (None, Decimal(1))],
        "q int, p decimal(10,2)",
    )
    revenue, cost, profit = line_metrics(F.col("q"), F.col("p"))
    found = [tuple(r) for r in df.select(revenue, cost, profit).collect()]
    assert found == [
        (Decimal("0.01"), Decimal("0.01"), Decimal("0.00")),
        (Decimal("29.97"), Decimal("17.98"), Decimal("11.99")),
        (None, None, None),
        (None, None, None),
    ]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("3.00")), (Decimal("1.00"), Decimal("0.00"))],
        "a decimal(20,2), b decimal(20,2)",
    )
    assert column(df, ratio("a", "b")) == [Decimal("0.33"), None]
    assert column(df, percent("a", "b")) == [Decimal("33.33"), None]


def test_customer_tier(spark):
    ids = values(spark, "string", "10", "5", "7", "0", "x", None, "30000000000")
    assert column(ids, customer_tier(F.col("v"))) == [
        "VIP", "ACTIVE", "NEW", "VIP", "NEW", "NEW", "VIP",
    ]


@pytest.mark.parametrize(
    ("days", "score"),
    [(0, 5), (30, 5), (31, 4), (90, 4), (91, 3), (180, 3), (181, 2), (365, 2), (366, 1), (9999, 1)],
)
def test_recency_limits(spark, days, score):
    limits = RfmThresholds().recency_days
    assert column(values(spark, "int", days), threshold_score(F.col("v"), limits, True)) == [score]


def test_frequency_and_monetary_limits(spark):
    limits = RfmThresholds()
    orders = values(spark, "bigint", 0, 1, 2, 3, 4, 6, 7, 9, 10)
    assert column(orders, threshold_score(F.col("v"), limits.orders)) == [1, 1, 2, 2, 3, 3, 4, 4, 5]
    money = values(
        spark, "decimal(20,2)",
        *map(Decimal, "0 49.99 50 199.99 200 499.99 500 999.99 1000".split()),
    )
    assert column(money, threshold_score(F.col("v"), limits.revenue)) == [1, 1, 2, 2, 3, 3, 4, 4, 5]


def expected_segment(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 3 and f >= 3:
        return "Loyal Customers"
    if r >= 4 and f <= 2:
        return "Promising"
    if r <= 2 and f >= 4:
        return "At Risk"
    if r <= 2 and m >= 4:
        return "Can't Lose Them"
    return "Hibernating" if r <= 2 else "Needs Attention"


def test_every_score_has_one_segment(spark):
    scores = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(scores, "r int, f int, m int")
    found = df.select("*", rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s"))
    assert rows(found) == sorted(
        ((*s, expected_segment(*s)) for s in scores), key=lambda r: [(False, str(v)) for v in r]
    )
    assert found.select("s").distinct().count() == 7
