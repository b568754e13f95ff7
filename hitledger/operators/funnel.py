"""Funnels: steps that a user takes one after the other, within a limit of time.

A user has reached a step if the steps up to it can be found at strictly later times each, the
last within the limit after the first. Whether that is so is a fold over the user's events in
order of time; it is done in two levels, so that no task holds all events of a user. Events are
folded by user and chunk of time to one row of times, and a user's chunks, at most one for each
chunk of the calendar, are folded in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = ("page_view", "click", "purchase")
LIMIT_DAYS = 3
CHUNK = "1 hour"


def _within(time: Column, start: Column, limit: Column) -> Column:
    return F.coalesce(time <= start + limit, F.lit(False))


def _when(condition: Column, value: Column, otherwise: Column) -> Column:
    return F.when(condition, value).otherwise(otherwise)


def _fold_events(ordered: Column, limit: Column) -> Column:
    """What a chunk's events do, alone or after earlier ones.

    viewed: the last view; clicked_view: the last view that a click follows; click, purchase and
    click_purchase: the first of each, the last after a click; clicked and bought: reached within
    the chunk.
    """
    names = ["viewed", "clicked_view", "click", "purchase", "click_purchase"]
    none = [F.lit(None).cast("timestamp_ntz").alias(n) for n in names]
    start = F.struct(*none, F.lit(False).alias("clicked"), F.lit(False).alias("bought"))

    def step(s: Column, e: Column) -> Column:
        t, is_view, is_click, is_purchase = e["t"], e["step"] == 1, e["step"] == 2, e["step"] == 3
        after_click = is_purchase & s["click"].isNotNull()
        return F.struct(
            _when(is_view, t, s["viewed"]).alias("viewed"),
            _when(is_click, F.coalesce(s["viewed"], s["clicked_view"]), s["clicked_view"]).alias("clicked_view"),
            _when(is_click, F.coalesce(s["click"], t), s["click"]).alias("click"),
            _when(is_purchase, F.coalesce(s["purchase"], t), s["purchase"]).alias("purchase"),
            _when(after_click, F.coalesce(s["click_purchase"], t), s["click_purchase"]).alias("click_purchase"),
            (s["clicked"] | (is_click & _within(t, s["viewed"], limit))).alias("clicked"),
            (s["bought"] | (is_purchase & _within(t, s["clicked_view"], limit))).alias("bought"),
        )

    return F.aggregate(ordered, start, step)


def _fold_chunks(ordered: Column, limit: Column) -> Column:
    none = F.lit(None).cast("timestamp_ntz")
    start = F.struct(
        none.alias("viewed"),
        none.alias("clicked_view"),
        F.lit(False).alias("clicked"),
        F.lit(False).alias("bought"),
    )

    def step(s: Column, chunk: Column) -> Column:
        c = chunk["done"]
        carried = F.when(c["click"].isNotNull(), s["viewed"])
        return F.struct(
            F.coalesce(c["viewed"], s["viewed"]).alias("viewed"),
            F.coalesce(c["clicked_view"], carried, s["clicked_view"]).alias("clicked_view"),
            (s["clicked"] | c["clicked"] | _within(c["click"], s["viewed"], limit)).alias("clicked"),
            (
                s["bought"]
                | c["bought"]
                | _within(c["purchase"], s["clicked_view"], limit)
                | _within(c["click_purchase"], s["viewed"], limit)
            ).alias("bought"),
        )

    return F.aggregate(ordered, start, step)


def user_funnel(
    events: DataFrame,
    steps: tuple[str, str, str] = STEPS,
    limit_days: int = LIMIT_DAYS,
    chunk: str = CHUNK,
) -> DataFrame:
    """The users that take any of the steps, and which steps each has reached.

    Of events at the same time none follows another: later steps are folded first. Events without
    a user or time do not count.
    """
    limit = F.expr(f"INTERVAL '{limit_days}' DAY")
    first, second, third = steps
    kind = F.col("event_type")
    step = F.when(kind == first, 1).when(kind == second, 2).when(kind == third, 3)
    taken = events.where(
        F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull() & kind.isin(*steps)
    ).select("user_id", F.col("event_timestamp").alias("t"), step.alias("step"))
    # One row for all events of a user, time and step; the later step sorts first.
    moments = F.collect_set(F.struct("t", (-F.col("step")).alias("rank"), "step"))
    chunks = taken.groupBy("user_id", F.window("t", chunk).start.alias("chunk")).agg(
        _fold_events(F.array_sort(moments), limit).alias("done")
    )
    folded = chunks.groupBy("user_id").agg(
        _fold_chunks(F.array_sort(F.collect_list(F.struct("chunk", "done"))), limit).alias("all")
    )
    return folded.select(
        "user_id",
        F.col("all.viewed").isNotNull().alias("viewed"),
        F.col("all.clicked").alias("clicked"),
        F.col("all.bought").alias("bought"),
    )


def country_steps(events: DataFrame, users: DataFrame, **how) -> DataFrame:
    """Users per country that reached each step of the funnel."""
    reached = user_funnel(events, **how).join(users.select("user_id", "country"), "user_id")
    return reached.groupBy("country").agg(
        F.count_if("viewed").alias("viewed_users"),
        F.count_if("clicked").alias("clicked_users"),
        F.count_if("bought").alias("bought_users"),
    )
