"""Customer tier and the recency / frequency / monetary scores and segments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RfmThresholds:
    """Limits for scores 5, 4, 3 and 2; everything beyond scores 1. Fixed values."""

    recency_days: tuple[int, ...] = (30, 90, 180, 365)
    orders: tuple[int, ...] = (10, 7, 4, 2)
    revenue: tuple[int, ...] = (1000, 500, 200, 50)

    def with_revenue_factor(self, factor: int) -> "RfmThresholds":
        return RfmThresholds(
            self.recency_days, self.orders, tuple(limit * factor for limit in self.revenue)
        )


def customer_tier(customer_id: Column) -> Column:
    """Tier from the numeric id; ids that are not numbers count as new."""
    number = customer_id.try_cast("bigint")
    return (
        F.when(number % 10 == 0, "VIP").when(number % 5 == 0, "ACTIVE").otherwise("NEW")
    )


def threshold_score(measure: Column, limits: Sequence[int], low_is_good: bool = False) -> Column:
    """Score 5 for the first limit met, one less for each later one, else 1."""
    graded = zip(range(5, 0, -1), limits)
    hits = [(measure <= limit if low_is_good else measure >= limit, score) for score, limit in graded]
    first, *rest = hits
    ladder = reduce(lambda chain, hit: chain.when(*hit), rest, F.when(*first))
    return ladder.otherwise(1)


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Named segment; the first matching row of the table below wins."""
    # Segment names and the score combinations they stand for.
    table = [
        ("Champions", (recency >= 4) & (frequency >= 4) & (monetary >= 4)),
        ("Loyal Customers", (recency >= 3) & (frequency >= 3)),
        ("Promising", (recency >= 4) & (frequency <= 2)),
        ("At Risk", (recency <= 2) & (frequency >= 4)),
        ("Can't Lose Them", (recency <= 2) & (monetary >= 4)),
        ("Hibernating", recency <= 2),
    ]
    return F.coalesce(*[F.when(rule, name) for name, rule in table], F.lit("Needs Attention"))
