"""The nightly job, incremental: daily and weekly figures and active users, after each load.

The high-water mark is kept in the daily table itself: each row names the newest load that its
day has seen, and the greatest of them is the load up to which the tables are complete. Rows and
mark therefore change in the same switch.

A run looks up which days newer loads have touched, late events included, and counts those days
anew from all of their events; other days' events are not read and their rows are copied, which
costs a row a day. Weeks that hold a touched day are added up from the new daily rows. All of it
is computed and written before the first table changes; the daily table, and with it the mark, is
switched last, so a run that fails at any point is simply repeated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger import schemas
from hitledger.functions.calendar import days_before
from hitledger.plans.jobs import create_weekly_summary, weekly_summary
from hitledger.sources import arrivals
from hitledger.sources.catalog import create_table, staged, switch_to

ACTIVE_DAYS = 30


def create_nightly(spark: SparkSession, daily: str, weekly: str, active: str) -> None:
    create_table(spark, daily, schemas.NIGHTLY_DAILY, schemas.AUDIT_COLUMN["daily_summary"])
    create_weekly_summary(spark, weekly)
    create_table(spark, active, schemas.ACTIVE_USERS)


def high_water_mark(spark: SparkSession, daily: str) -> int | None:
    return spark.table(daily).agg(F.max("last_load")).first()[0]


def daily_counts(events: DataFrame) -> DataFrame:
    """Per day: events, distinct users and sessions, and the newest load."""
    return events.groupBy("event_date").agg(
        F.count("*").alias("event_count"),
        F.countDistinct("user_id").alias("unique_users"),
        F.countDistinct("session_id").alias("unique_sessions"),
        F.max("load_id").alias("last_load"),
    )


def active_users(events: DataFrame) -> DataFrame:
    """Users of the events, with their last day and number of events."""
    return (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max("event_date").alias("last_active"), F.count("*").alias("event_count"))
    )


def run_nightly(
    spark: SparkSession, events: str, daily: str, weekly: str, active: str, active_days: int = ACTIVE_DAYS
) -> set[dt.date | None]:
    """Bring the three tables up to the newest load; returns the days counted anew.

    Without a newer load nothing is read or written. Active users are those of the last
    `active_days` days up to the newest day with events.
    """
    days = arrivals.touched_days(spark, events, high_water_mark(spark, daily))
    if not days:
        return days
    counted = daily_counts(arrivals.events_of(spark, events, days))
    kept = spark.table(daily).where(~arrivals.is_among("event_date", days))
    folders = {daily: staged(counted, daily, keep=kept)}

    fresh = spark.read.schema(spark.table(daily).schema).parquet(folders[daily])
    weeks = {day and day - dt.timedelta(days=day.weekday()) for day in days}
    newest = max((day for _, day in arrivals.partitions(spark, events) if day), default=None)
    week = F.trunc("event_date", "WEEK")
    of_weeks = fresh.withColumn("week", week).where(arrivals.is_among("week", weeks)).drop("week")
    other_weeks = spark.table(weekly).where(~arrivals.is_among("week_start", weeks))
    recent = F.lit(False) if newest is None else F.col("event_date") > days_before(newest, active_days)
    folders = {
        weekly: staged(weekly_summary(of_weeks), weekly, keep=other_weeks),
        active: staged(active_users(spark.table(events).where(recent)), active),
        **folders,
    }
    switch_to(spark, folders)
    return days
