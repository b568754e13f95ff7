"""Batch jobs that refresh the summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger import schemas
from hitledger.functions.calendar import week_end, week_start
from hitledger.plans.views import daily_events
from hitledger.sources.catalog import create_table, full_refresh


def create_daily_summary(spark: SparkSession, table: str) -> None:
    create_table(spark, table, schemas.DAILY_SUMMARY, schemas.AUDIT_COLUMN["daily_summary"])


def refresh_daily_summary(raw_events: DataFrame, table: str) -> None:
    """Replace the daily table by the counts of all events."""
    full_refresh(daily_events(raw_events), table)


def latest_days(daily_summary: DataFrame, limit: int = 10) -> DataFrame:
    return daily_summary.orderBy(F.desc("event_date")).limit(limit)


def weekly_summary(daily_summary: DataFrame) -> DataFrame:
    """Weeks from Monday on, out of the daily table.

    `unique_users` adds up the daily figures, so a user active on three days
    of a week counts three times.
    """
    day = F.col("event_date")
    return daily_summary.groupBy(
        week_start(day).alias("week_start"), week_end(day).alias("week_end")
    ).agg(F.sum("event_count").alias("event_count"), F.sum("unique_users").alias("unique_users"))


def create_weekly_summary(spark: SparkSession, table: str) -> None:
    create_table(spark, table, schemas.WEEKLY_SUMMARY)


def refresh_daily_then_weekly(raw_events: DataFrame, daily: str, weekly: str) -> None:
    """The nightly chain: the weekly table starts from the finished daily one."""
    refresh_daily_summary(raw_events, daily)
    full_refresh(weekly_summary(raw_events.sparkSession.table(daily)), weekly)
