"""The two reporting views and their reads.

Each view is a function from its tables to a lazy frame, so reading it re-runs
the query; `sources.catalog.register_view` gives it a name for SQL in a session.
`create_views` defines both for good, over catalog tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.calendar import days_before, event_date_sql
from hitledger.functions.measures import ratio
from hitledger.sources.catalog import create_view

_DAILY_EVENTS = """
    SELECT {day} AS event_date, count(*) AS event_count,
           count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions
    FROM {events} GROUP BY ALL
"""
# Rolled up before the join, for the reasons given in `rollups.daily_by_user_columns`.
_COUNTRY_DAILY_SUMMARY = """
    SELECT event_date, home.country, sum(events) AS event_count,
           count(DISTINCT user_id) AS user_count, count(DISTINCT purchase_id) AS purchase_count
    FROM (
        SELECT {day} AS event_date, user_id, count(*) AS events,
               if(event_type = 'purchase', event_id, NULL) AS purchase_id
        FROM {events} GROUP BY ALL
    ) JOIN {users} AS home USING (user_id) GROUP BY ALL
"""


def daily_events(raw_events: DataFrame) -> DataFrame:
    """The view `v_daily_events`."""
    text = _DAILY_EVENTS.format(day=event_date_sql(raw_events.columns), events="{events}")
    return raw_events.sparkSession.sql(text, events=raw_events)


def recent_days(view: DataFrame, as_of: dt.date | None = None, days: int = 7) -> DataFrame:
    """Rows of a daily view from `days` before `as_of` on, latest first."""
    return view.filter(F.col("event_date") >= days_before(as_of, days)).orderBy(F.desc("event_date"))


def country_daily_summary(raw_events: DataFrame, users: DataFrame) -> DataFrame:
    """The view `v_country_daily_summary`."""
    day = event_date_sql(raw_events.columns)
    text = _COUNTRY_DAILY_SUMMARY.format(day=day, events="{events}", users="{users}")
    return raw_events.sparkSession.sql(text, events=raw_events, users=users)


def country_purchase_rate(
    view: DataFrame, as_of: dt.date | None = None, days: int = 7
) -> DataFrame:
    """Purchases per user from the country view, for its last days."""
    return (
        view.filter(F.col("event_date") >= days_before(as_of, days))
        .select(
            "event_date",
            "country",
            "event_count",
            "purchase_count",
            ratio(F.col("purchase_count"), F.col("user_count"), 4).alias("purchase_rate"),
        )
        .orderBy(F.desc("event_date"), F.desc("purchase_count"))
    )


def create_views(spark: SparkSession, database: str, raw_events: str, users: str) -> None:
    """Both views in a database, over the catalog tables named."""
    day = event_date_sql(spark.table(raw_events).columns)
    tables = {"day": day, "events": raw_events, "users": users}
    create_view(spark, f"{database}.v_daily_events", _DAILY_EVENTS.format(**tables))
    country = _COUNTRY_DAILY_SUMMARY.format(**tables)
    create_view(spark, f"{database}.v_country_daily_summary", country)
