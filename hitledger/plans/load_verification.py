"""What to look at after a load: sizes, orphans, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.operators.checks import row_counts
from hitledger.operators.integrity import orphan_count


def read_back(table: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """A few rows of a loaded table, those with the lowest keys."""
    return table.orderBy(key).limit(limit)


def table_row_counts(users: DataFrame, sessions: DataFrame, raw_events: DataFrame) -> DataFrame:
    return row_counts({"USERS": users, "SESSIONS": sessions, "RAW_EVENTS": raw_events})


def orphaned_sessions(sessions: DataFrame, users: DataFrame) -> DataFrame:
    return orphan_count(sessions, users, "user_id", "orphaned_sessions")


def orphaned_events(raw_events: DataFrame, users: DataFrame) -> DataFrame:
    return orphan_count(raw_events, users, "user_id", "orphaned_events")


def orphaned_events_by_session(raw_events: DataFrame, sessions: DataFrame) -> DataFrame:
    return orphan_count(raw_events, sessions, "session_id", "orphaned_events_by_session")


def users_by_country(users: DataFrame) -> DataFrame:
    return users.groupBy("country").agg(F.count("*").alias("user_count")).orderBy(F.desc("user_count"))


def event_type_distribution(raw_events: DataFrame) -> DataFrame:
    return (
        raw_events.groupBy("event_type")
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"))
    )


def top_users(raw_events: DataFrame, limit: int = 10) -> DataFrame:
    """The busiest users; the lower id goes first among equals."""
    return (
        raw_events.groupBy("user_id")
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), "user_id")
        .limit(limit)
    )


def device_session_stats(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("device_type").agg(
        F.count("*").alias("session_count"),
        F.round(F.avg("page_views"), 2).alias("avg_page_views"),
        F.max("page_views").alias("max_page_views"),
    )
