"""Layered models: staging frames over the sources, and the daily mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.calendar import event_date_sql
from hitledger.functions.measures import is_type
from hitledger.operators.checks import Check, failing_rows, run_checks
from hitledger.sources.catalog import create_view, layer, materialize, store_failures


# The staging models as SQL, over a frame or, in a lasting view, over a catalog table.
_STG_EVENTS = """
    SELECT event_id, user_id, session_id, event_type, event_timestamp,
           {day} AS event_date
    FROM {source} WHERE event_id IS NOT NULL AND user_id IS NOT NULL
"""
_STG_USERS = """
    SELECT user_id, signup_date, upper(country) AS country, plan_type, is_active
    FROM {source}
"""


def stg_events(raw_events: DataFrame) -> DataFrame:
    """Events that have both keys, with their day."""
    text = _STG_EVENTS.format(day=event_date_sql(raw_events.columns), source="{source}")
    return raw_events.sparkSession.sql(text, source=raw_events)


def stg_users(users: DataFrame) -> DataFrame:
    """Users with their country code in upper case."""
    return users.sparkSession.sql(_STG_USERS, source=users)


def daily_summary(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events, users and purchases per day and country, from the staging frames.

    Both sides are rolled up before they meet. Events shrink to one row per
    user and day in the map-side combine, so a user with a third of all events
    brings one row per day to the join. Users shrink to one row per user and
    country with the number of copies, which the sums are multiplied by; that
    leaves each (day, country, user) once after the join, so the distinct users
    of a group are its row count and need no shuffle of their own. The users are
    dealt out by the join's key at once, which serves their grouping as well.
    """
    user_days = events.groupBy("event_date", "user_id").agg(
        F.count("*").alias("events"),
        F.count_if(is_type("purchase")).alias("purchases"),
    )
    homes = users.repartition("user_id").groupBy("user_id", "country").agg(F.count("*").alias("copies"))
    return (
        user_days.join(homes, "user_id")
        .groupBy("event_date", "country")
        .agg(
            F.sum(F.col("events") * F.col("copies")).alias("event_count"),
            F.count("*").alias("unique_users"),
            F.sum(F.col("purchases") * F.col("copies")).alias("purchase_count"),
        )
    )


# The declared checks of the models.
CHECKS = [
    Check("stg_events", "event_id", "unique"),
    Check("stg_events", "event_id", "not_null"),
    Check("stg_events", "user_id", "not_null"),
    Check("stg_events", "event_date", "not_null"),
    Check("stg_users", "user_id", "unique"),
    Check("stg_users", "user_id", "not_null"),
    Check("daily_summary", "event_date", "not_null"),
    Check("daily_summary", "country", "not_null"),
    Check("daily_summary", "event_count", "not_null"),
]


def model_frames(raw_events: DataFrame, users: DataFrame) -> dict[str, DataFrame]:
    """All models over two source frames, nothing materialized."""
    events, members = stg_events(raw_events), stg_users(users)
    return {
        "stg_events": events,
        "stg_users": members,
        "daily_summary": daily_summary(events, members),
    }


def build_models(
    spark: SparkSession, base: str, raw_events: str, users: str, location: str | None = None
) -> dict[str, str]:
    """Build every layer from two catalog tables; returns the model's full names.

    Staging becomes views in `<base>_staging`, the mart a table in
    `<base>_marts`, so the mart is computed once and the checks read it back.
    """
    staging = layer(spark, base, "staging", location)
    marts = layer(spark, base, "marts", location)
    names = {
        "stg_events": f"{staging}.stg_events",
        "stg_users": f"{staging}.stg_users",
        "daily_summary": f"{marts}.daily_summary",
    }
    day = event_date_sql(spark.table(raw_events).columns)
    create_view(spark, names["stg_events"], _STG_EVENTS.format(source=raw_events, day=day))
    create_view(spark, names["stg_users"], _STG_USERS.format(source=users))
    mart = daily_summary(spark.table(names["stg_events"]), spark.table(names["stg_users"]))
    materialize(mart, names["daily_summary"], "table")
    return names


def check_models(
    spark: SparkSession, base: str, names: dict[str, str], location: str | None = None
) -> DataFrame:
    """Run the declared checks on built models and keep what they object to.

    The report goes to `<base>_checks.report`. The failing rows of a check go to
    a table of their own beside it; only checks that fail read their model a
    second time, and a check that passes leaves no rows of an earlier run.
    """
    audit = layer(spark, base, "checks", location)
    models = {model: spark.table(name) for model, name in names.items()}
    report = f"{audit}.report"
    materialize(run_checks(models, CHECKS), report, "table")
    failed = spark.table(report).filter("failures > 0")
    failing = {Check(r.model, r.column_name, r.check_name) for r in failed.collect()}
    for check in CHECKS:
        table = f"{audit}.{check.name}_{check.model}_{check.column}"
        if check in failing:
            store_failures(failing_rows(models[check.model], check), table)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.table(report)
