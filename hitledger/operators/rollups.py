"""Per-day roll-ups of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.functions.calendar import with_event_date
from hitledger.functions.measures import is_type


def daily_users(events: DataFrame) -> DataFrame:
    """Events and distinct users per day."""
    return (
        with_event_date(events)
        .groupBy("event_date")
        .agg(F.count("*").alias("event_count"), F.countDistinct("user_id").alias("unique_users"))
    )


def daily_by_user_columns(events: DataFrame, users: DataFrame, columns: list[str]) -> DataFrame:
    """Events, distinct users and distinct purchases per day and user columns.

    Events are first rolled up to one row per user, day and purchase, so a
    user's other events never travel one by one and a busy user brings few rows
    to the join. Purchases keep their id through the join, because the same id
    under two users of one group counts once. Should one user hold most of the
    purchases, the join sides come straight from their shuffles and adaptive
    execution splits the skewed one.
    """
    purchase_id = F.when(is_type("purchase"), F.col("event_id"))
    user_days = (
        with_event_date(events)
        .groupBy("event_date", "user_id", purchase_id.alias("purchase_id"))
        .agg(F.count("*").alias("events"))
    )
    return (
        user_days.join(users.select("user_id", *columns), "user_id")
        .groupBy("event_date", *columns)
        .agg(
            F.sum("events").alias("event_count"),
            F.countDistinct("user_id").alias("user_count"),
            F.countDistinct("purchase_id").alias("purchase_count"),
        )
    )
