"""First looks at the data: samples, lookups, grouped counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.functions.measures import is_type
from hitledger.operators.integrity import orphans
from hitledger.operators.rollups import daily_users
from hitledger.operators.sampling import lowest_rows


def event_sample(raw_events: DataFrame, limit: int = 10) -> DataFrame:
    """Some events, all columns; the lowest ids, so that runs agree."""
    return lowest_rows(raw_events, "event_id", limit)


def purchases_in_countries(
    raw_events: DataFrame, countries: tuple[str, ...] = ("US", "JP"), limit: int = 20
) -> DataFrame:
    """Purchases by the country on the event."""
    return (
        raw_events.filter(is_type("purchase") & F.col("country").isin(*countries))
        .select("event_id", "user_id", "event_type", "event_timestamp", "country")
        .orderBy("event_id")
        .limit(limit)
    )


def event_types(raw_events: DataFrame) -> DataFrame:
    return raw_events.select("event_type").distinct().orderBy("event_type")


def purchases_with_user(raw_events: DataFrame, users: DataFrame, limit: int = 20) -> DataFrame:
    """Purchases with their user's country and plan."""
    purchases = raw_events.filter(is_type("purchase")).select(
        "event_id", "user_id", "event_type", "event_timestamp"
    )
    return (
        purchases.join(users.select("user_id", "country", "plan_type"), "user_id")
        .select("event_id", "user_id", "event_type", "event_timestamp", "country", "plan_type")
        .orderBy("event_id")
        .limit(limit)
    )


def orphan_events(raw_events: DataFrame, users: DataFrame, limit: int = 20) -> DataFrame:
    """Events of unknown users; the plan is the one such a user does not have."""
    return (
        orphans(raw_events.select("event_id", "user_id"), users, "user_id")
        .select("event_id", "user_id", F.lit(None).cast("string").alias("plan_type"))
        .orderBy("event_id")
        .limit(limit)
    )


def daily_event_counts(raw_events: DataFrame) -> DataFrame:
    return (
        daily_users(raw_events)
        .withColumnRenamed("event_count", "total_events")
        .orderBy(F.desc("event_date"))
    )


def country_funnel(raw_events: DataFrame, users: DataFrame) -> DataFrame:
    """Events, page views and purchases per user country, side by side.

    Counted per user first: the shuffle carries one row per user and task, and
    the join finds the counts already partitioned by its key.
    """
    per_user = raw_events.groupBy("user_id").agg(
        F.count("*").alias("events"),
        F.count_if(is_type("page_view")).alias("pageviews"),
        F.count_if(is_type("purchase")).alias("purchases"),
    )
    return (
        per_user.join(users.select("user_id", "country"), "user_id")
        .groupBy("country")
        .agg(
            F.sum("events").alias("total_events"),
            F.sum("pageviews").alias("pageview_count"),
            F.sum("purchases").alias("purchase_count"),
        )
        .orderBy(F.desc("total_events"))
    )


def heavy_users(raw_events: DataFrame, min_events: int = 100) -> DataFrame:
    """Users with more than `min_events` events, most first.

    The id as second sort key lets the range shuffle cut through a count that
    very many users share.
    """
    return (
        raw_events.groupBy("user_id")
        .agg(F.count("*").alias("event_count"))
        .filter(F.col("event_count") > min_events)
        .orderBy(F.desc("event_count"), "user_id")
    )
