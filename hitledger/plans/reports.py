"""Multi-step reports: recent days, purchase rates, conversion tiers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.functions.calendar import days_before, with_event_date
from hitledger.functions.measures import conversion_tier, is_type, ratio
from hitledger.operators.rollups import daily_by_user_columns, daily_users


def recent_daily_events(
    raw_events: DataFrame, as_of: dt.date | None = None, days: int = 7
) -> DataFrame:
    """Daily counts from `days` before `as_of` on; the filter reaches the scan."""
    return (
        daily_users(raw_events)
        .filter(F.col("event_date") >= days_before(as_of, days))
        .orderBy(F.desc("event_date"))
    )


def daily_purchase_rate(raw_events: DataFrame) -> DataFrame:
    """Purchases per event and day, 0 on days without any.

    One pass counts all events and the purchases among them. Events without a
    day form a group that no purchase belongs to.
    """
    bought = is_type("purchase") & F.col("event_date").isNotNull()
    daily = (
        with_event_date(raw_events)
        .groupBy("event_date")
        .agg(
            F.count("*").alias("event_count"),
            F.countDistinct("user_id").alias("unique_users"),
            F.count_if(bought).alias("purchase_count"),
        )
    )
    rate = ratio(F.col("purchase_count"), F.col("event_count"), 4)
    return daily.withColumn("purchase_rate", rate).orderBy(F.desc("event_date"))


def conversion_tiers(
    raw_events: DataFrame, users: DataFrame, as_of: dt.date | None = None, days: int = 30
) -> DataFrame:
    """Activity, purchase rate per user and tier by day, country and plan."""
    recent = with_event_date(raw_events).filter(F.col("event_date") >= days_before(as_of, days))
    performance = daily_by_user_columns(recent, users, ["country", "plan_type"])
    return (
        performance.withColumn("events_per_user", ratio(F.col("event_count"), F.col("user_count"), 2))
        .withColumn("purchase_rate", ratio(F.col("purchase_count"), F.col("user_count"), 4))
        .withColumn("conversion_tier", conversion_tier(F.col("purchase_rate")))
        .orderBy(F.desc("event_date"), F.desc("purchase_rate"))
    )
