"""Base tables derived from the `events` and `customer` test tables.

The test data has no access-log schema of its own, so its events become
`raw_events`, its customers `users`, and the user-days of the events
`sessions`. Columns without a source (session, device, country, plan, signup
date, activity flag) are stand-ins computed by fixed rules. The audit columns
are left out: they are load times, filled when a table is loaded.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The last day of the test events, used wherever a query asks for "today".
AS_OF = dt.date(2024, 1, 30)

# Country codes by nation key, devices by user id, both modulo
# their number; session names; and the first of the spread signup dates.
_COUNTRY = "element_at(array('US', 'JP', 'GB', 'DE', 'FR', 'CA', 'AU', 'SG', 'IN', 'BR'), c_nationkey % 10 + 1)"
_DEVICE = "element_at(array('desktop', 'mobile', 'tablet'), int(user_id % 3) + 1)"
_SESSION = "concat('session_', user_id, '_', date_format({day}, 'yyyyMMdd'))"
_SIGNUP = "date_add(DATE'2023-08-03', int(c_custkey % 181))"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, only: str | None = None) -> DataFrame:
    """Events under their access-log names, without the country.

    Few queries read the country of an event and it costs a join, so those
    add it with `with_country`. The names of event types are mapped, which
    hides a filter on them from Parquet; `only` sets it on the source column,
    for a type that goes by the same name there.
    """
    source = _table(spark, sf_dir, "events")
    if only:
        source = source.filter(F.col("event_type") == only)
    return source.selectExpr(
        "event_id",
        "user_id",
        f"{_SESSION.format(day='ts')} AS session_id",
        """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'sign_up'
           ELSE event_type END AS event_type""",
        "string(NULL) AS page_url",
        "ts AS event_timestamp",
        f"{_DEVICE} AS device_type",
    )


def with_country(spark: SparkSession, sf_dir: str, events: DataFrame, few: bool = False) -> DataFrame:
    """Add the country of the customer behind each event, if there is one.

    `few` says that a limit bounds the events: then one scan of the customers
    finds theirs, and only those rows meet the events.
    """
    homes = _table(spark, sf_dir, "customer").selectExpr("c_custkey AS user_id", f"{_COUNTRY} AS country")
    if few:
        homes = homes.join(F.broadcast(events.select("user_id")), "user_id", "left_semi")
    return events.join(homes, "user_id", "left").select(*events.columns, "country")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit; events of the others are left without a user."""
    customers = _table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return customers.selectExpr(
        "c_custkey AS user_id",
        f"{_SIGNUP} AS signup_date",
        f"{_COUNTRY} AS country",
        "if(c_mktsegment = 'BUILDING', 'premium', 'free') AS plan_type",
        "c_acctbal > 2000 AS is_active",
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-days with at least one page view.

    Grouped by the two narrow keys every other column follows from; the session
    and device names are built after the shuffle.
    """
    user_days = (
        _table(spark, sf_dir, "events")
        .groupBy("user_id", F.expr("date(ts)").alias("day"))
        .agg(
            F.min("ts").alias("session_start"),
            F.max("ts").alias("session_end"),
            F.expr("count_if(event_type = 'view')").alias("page_views"),
        )
    )
    return user_days.filter("page_views >= 1").selectExpr(
        f"{_SESSION.format(day='day')} AS session_id",
        "user_id",
        "session_start",
        "session_end",
        "page_views",
        f"{_DEVICE} AS device_type",
    )
