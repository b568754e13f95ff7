"""Sessions by inactivity: a user's events with no longer pause than a gap between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitledger.functions.measures import is_type, ratio

GAP_SECONDS = 30 * 60


def gap_sessions(events: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """One row per session: a pause of more than `gap_seconds` starts the next one.

    Events are first rolled up by user and slot of time as long as the gap. Two events of one slot
    are closer than the gap, so a slot lies within one session, and a user has at most one row per
    slot however many events: the busiest user of a year is 17,520 rows for a gap of half an hour.
    Only these rows are ordered per user. Events without a user or time belong to no session.
    Sessions of a user are numbered from 1 in order of time.
    """
    slots = (
        events.where(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull())
        .groupBy("user_id", F.window("event_timestamp", f"{gap_seconds} seconds").start.alias("slot"))
        .agg(
            F.min("event_timestamp").alias("first"),
            F.max("event_timestamp").alias("last"),
            F.count("*").alias("events"),
            F.count_if(is_type("page_view")).alias("views"),
            F.count_if(is_type("purchase")).alias("bought"),
        )
    )
    in_time = Window.partitionBy("user_id").orderBy("slot")
    before = F.lag("last").over(in_time)
    starts = before.isNull() | (F.col("first") > before + F.expr(f"INTERVAL '{gap_seconds}' SECOND"))
    numbered = slots.withColumn("starts", starts.cast("long")).withColumn(
        "session_no", F.sum("starts").over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    sessions = numbered.groupBy("user_id", "session_no").agg(
        F.min("first").alias("session_start"),
        F.max("last").alias("session_end"),
        F.sum("events").alias("event_count"),
        F.sum("views").alias("page_views"),
        F.sum("bought").alias("purchases"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end"))
    return sessions.withColumn("duration_seconds", seconds)


def session_summary(sessions: DataFrame) -> DataFrame:
    """Sessions, users and averages per day on which the sessions start."""
    n = F.col("session_count")
    return (
        sessions.groupBy(F.to_date("session_start").alias("session_date"))
        .agg(
            F.count("*").alias("session_count"),
            F.countDistinct("user_id").alias("user_count"),
            F.sum("event_count").alias("event_count"),
            F.count_if(F.col("event_count") == 1).alias("single_event_sessions"),
            F.sum("duration_seconds").alias("seconds"),
            F.max("duration_seconds").alias("longest_seconds"),
        )
        .select(
            "session_date",
            "session_count",
            "user_count",
            "event_count",
            "single_event_sessions",
            ratio(F.col("event_count"), n, 2).alias("events_per_session"),
            ratio(F.col("seconds"), n, 2).alias("avg_seconds"),
            "longest_seconds",
        )
    )
