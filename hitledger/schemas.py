"""Typed shapes of the base and summary tables.

Spark neither enforces keys nor NOT NULL on Parquet tables, so the flags below
are declarations: the CSV loader enforces them while loading
(`sources.csv_files`), and the checks in `operators.checks` report on tables
that are already there. A text column's declared length is kept as metadata.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _text(name: str, length: int, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable, {"max_length": length})


RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("user_id", T.LongType(), False),
        _text("session_id", 50, nullable=False),
        _text("event_type", 50, nullable=False),
        _text("page_url", 500),
        T.StructField("event_timestamp", T.TimestampNTZType(), False),
        _text("device_type", 20),
        _text("country", 2),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("signup_date", T.DateType(), False),
        _text("country", 2, nullable=False),
        _text("plan_type", 20, nullable=False),
        T.StructField("is_active", T.BooleanType(), False),
    ]
)

SESSIONS = T.StructType(
    [
        _text("session_id", 50, nullable=False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("session_start", T.TimestampNTZType(), False),
        T.StructField("session_end", T.TimestampNTZType(), False),
        T.StructField("page_views", T.LongType(), False),
        _text("device_type", 20),
    ]
)

DAILY_SUMMARY = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("unique_users", T.LongType()),
        T.StructField("unique_sessions", T.LongType()),
    ]
)

WEEKLY_SUMMARY = T.StructType(
    [
        T.StructField("week_start", T.DateType()),
        T.StructField("week_end", T.DateType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("unique_users", T.LongType()),
    ]
)

# Tables of the nightly job: `last_load` is the newest load that the row's day has seen.
NIGHTLY_DAILY = T.StructType([*DAILY_SUMMARY.fields, T.StructField("last_load", T.LongType())])

ACTIVE_USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("last_active", T.DateType()),
        T.StructField("event_count", T.LongType()),
    ]
)

# Column filled with the load time, by table. Tables that are
# not listed carry no such column.
AUDIT_COLUMN = {
    "raw_events": "created_at",
    "users": "updated_at",
    "sessions": "created_at",
    "daily_summary": "created_at",
}

# The legal codes of the two enumerated columns.
EVENT_TYPES = ["page_view", "click", "purchase", "sign_up", "add_to_cart", "checkout"]
PLAN_TYPES = ["free", "premium"]
