"""Sessions of customers and how far they come in a funnel, from typed events.

Events without a customer or a time belong to no session. A session's events are
folded in two steps, so that its array never holds more than an hour of them: every hour
becomes a small table that says where it takes the automaton from each of its states,
and the hours are applied to one another in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAP_MINUTES = 30


def event_sessions(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """A row for each session, events of a customer with at most the gap between one
    and the next: start and end of its events, their number, kinds and devices."""
    known = events.filter("customer_id is not null and event_time is not null")
    window = F.session_window("event_time", f"{gap_minutes} minutes")
    sessions = known.groupBy("customer_id", window).agg(
        F.min("event_time").alias("start"),
        F.max("event_time").alias("end"),
        F.count("*").alias("events"),
        F.count_distinct("event_type").alias("kinds"),
        F.max("device").alias("device"),
    )
    seconds = (F.unix_micros("end") - F.unix_micros("start")) / 1_000_000
    return sessions.select("customer_id", "start", "end", "events", "kinds", "device", seconds.alias("seconds"))


def in_sessions(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Events with ``session``, the time at which their session starts."""
    known = events.filter("customer_id is not null and event_time is not null")
    order = Window.partitionBy("customer_id").orderBy("event_time")
    gap = F.unix_micros("event_time") - F.unix_micros(F.lag("event_time").over(order))
    opens = F.when(gap.isNull() | (gap > gap_minutes * 60 * 1_000_000), F.col("event_time"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = known.withColumn("_opens", opens)
    return marked.withColumn("session", F.last("_opens", ignorenulls=True).over(upto)).drop("_opens")


def _advance(state: Column, kind: Column, steps: Sequence[str]) -> Column:
    """The automaton's next state: one more if the event is the step it waits for."""
    wanted = F.element_at(F.array(*[F.lit(s) for s in steps], F.lit(None).cast("string")), state + 1)
    return F.when(F.coalesce(kind == wanted, F.lit(False)), state + 1).otherwise(state)


def event_funnel(
    events: DataFrame, steps: Sequence[str], gap_minutes: int = GAP_MINUTES, by: Sequence[str] = ("customer_id", "session")
) -> DataFrame:
    """How many of ``steps`` each session (or each group of other columns) has passed in
    order, with other events between them allowed: 0 to the number of steps.

    Events at one time count in the order of their ids.
    """
    tagged = in_sessions(events, gap_minutes)
    tagged = tagged.withColumn("_hour", F.date_trunc("hour", "event_time"))
    # Events that are no step change no state; an hour without any still counts.
    step = F.when(F.col("event_type").isin(*steps), F.struct("event_time", "event_id", "event_type"))
    hours = tagged.groupBy(*by, "_hour").agg(F.array_sort(F.collect_list(step)).alias("_passed"))
    states = F.array(*[F.lit(k) for k in range(len(steps) + 1)])
    after = F.transform(
        states, lambda s: F.aggregate("_passed", s, lambda state, e: _advance(state, e["event_type"], steps))
    )
    folded = hours.select(*by, F.struct("_hour", after.alias("to")).alias("_hour"))
    whole = folded.groupBy(*by).agg(F.array_sort(F.collect_list("_hour")).alias("_hours"))
    reached = F.aggregate("_hours", F.lit(0), lambda state, h: F.element_at(h["to"], state + 1))
    return whole.select(*by, reached.alias("steps_passed"))


def funnel_counts(funnel: DataFrame, steps: Sequence[str]) -> DataFrame:
    """For each step how many passed it, as a share of all and of those before it."""
    number = F.explode(F.sequence(F.lit(0), F.lit(len(steps))))
    passed = funnel.groupBy("steps_passed").agg(F.count("*").alias("n")).withColumn("step", number)
    counted = passed.filter("steps_passed >= step").groupBy("step").agg(F.sum("n").alias("passed"))
    every = Window.orderBy("step")  # one row for each step
    name = F.element_at(F.array(F.lit("session"), *[F.lit(s) for s in steps]), F.col("step") + 1)
    percent = lambda of: F.round(100 * F.col("passed") / of, 2)
    return counted.select(
        "step", name.alias("name"), "passed",
        percent(F.first("passed").over(every)).alias("percent_of_all"),
        percent(F.lag("passed").over(every)).alias("percent_of_last"),
    )
