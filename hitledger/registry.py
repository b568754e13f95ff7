"""Every query by name, bound to the test tables.

Each entry takes a session and a folder of Parquet tables and returns a frame.
Entries that end in a table or file write it first, below the session's
checkpoint folder, and return its read-back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger import schemas
from hitledger.operators import checks, funnel, integrity, profiling
from hitledger.operators.sessions import gap_sessions, session_summary
from hitledger.plans import (
    activity,
    exploration,
    jobs,
    load_verification,
    models,
    nightly,
    reports,
    views,
)
from hitledger.sources import arrivals, catalog, clean_load, csv_files, layout
from hitledger.sources.driver_tables import AS_OF, raw_events, sessions, users, with_country
from hitledger.sources.scratch import ensure_checkpoints, scratch_database, scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _database(spark: SparkSession, name: str) -> tuple[str, str]:
    """A new database, and where it lives."""
    base, location = scratch_database(spark, name)
    return catalog.create_database(spark, base, f"{location}/{base}"), location


def _events(spark: SparkSession, d: str) -> DataFrame:
    """Whole events, the country included."""
    return with_country(spark, d, raw_events(spark, d))


def event_sample(spark: SparkSession, d: str) -> DataFrame:
    sample = exploration.event_sample(raw_events(spark, d))
    return with_country(spark, d, sample, few=True).orderBy("event_id")


def purchases_in_countries(spark: SparkSession, d: str) -> DataFrame:
    purchases = raw_events(spark, d, only="purchase")
    return exploration.purchases_in_countries(with_country(spark, d, purchases))


def purchases_with_user(spark: SparkSession, d: str) -> DataFrame:
    return exploration.purchases_with_user(raw_events(spark, d, only="purchase"), users(spark, d))


def v_daily_events(spark: SparkSession, d: str) -> DataFrame:
    catalog.register_view(views.daily_events(raw_events(spark, d)), "v_daily_events")
    return spark.table("v_daily_events")


def v_country_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    view = views.country_daily_summary(raw_events(spark, d), users(spark, d))
    catalog.register_view(view, "v_country_daily_summary")
    return spark.table("v_country_daily_summary")


def refresh_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    database, _ = _database(spark, "daily")
    table = f"{database}.daily_summary"
    jobs.create_daily_summary(spark, table)
    jobs.refresh_daily_summary(raw_events(spark, d), table)
    return jobs.latest_days(spark.table(table)).drop("created_at")


def weekly_summary(spark: SparkSession, d: str) -> DataFrame:
    database, _ = _database(spark, "weekly")
    daily, weekly = f"{database}.daily_summary", f"{database}.weekly_summary"
    jobs.create_daily_summary(spark, daily)
    jobs.create_weekly_summary(spark, weekly)
    jobs.refresh_daily_then_weekly(raw_events(spark, d), daily, weekly)
    return spark.table(weekly)


def _built(spark: SparkSession, d: str, name: str) -> tuple[str, str, dict[str, str]]:
    """Load the sources into typed tables and build the models over them."""
    base, location = _database(spark, name)
    loads = {
        "raw_events": (schemas.RAW_EVENTS, _events(spark, d)),
        "users": (schemas.USERS, users(spark, d)),
    }
    for table, (schema, rows) in loads.items():
        catalog.create_table(spark, f"{base}.{table}", schema, schemas.AUDIT_COLUMN[table])
        catalog.append(rows, f"{base}.{table}")
    names = models.build_models(spark, base, f"{base}.raw_events", f"{base}.users", location)
    return base, location, names


def model_build(spark: SparkSession, d: str) -> DataFrame:
    _, _, names = _built(spark, d, "build")
    return spark.table(names["daily_summary"])


def model_build_checks(spark: SparkSession, d: str) -> DataFrame:
    base, location, names = _built(spark, d, "checked")
    return models.check_models(spark, base, names, location)


def model_checks(spark: SparkSession, d: str) -> DataFrame:
    frames = models.model_frames(raw_events(spark, d), users(spark, d))
    return checks.run_checks(frames, models.CHECKS)


def accepted_values_check(spark: SparkSession, d: str) -> DataFrame:
    odd = checks.accepted_values(raw_events(spark, d), "event_type", schemas.EVENT_TYPES)
    return odd.groupBy("event_type").agg(F.count("*").alias("failures"))


def accepted_plans_check(spark: SparkSession, d: str) -> DataFrame:
    odd = checks.accepted_values(users(spark, d), "plan_type", schemas.PLAN_TYPES)
    return odd.agg(F.count("*").alias("failures"))


def accepted_range_check(spark: SparkSession, d: str) -> DataFrame:
    """Sessions outside one to three page views."""
    odd = checks.accepted_range(sessions(spark, d), "page_views", low=1, high=3)
    return odd.select("session_id", "page_views")


def stored_failures(spark: SparkSession, d: str) -> DataFrame:
    """Orphaned events kept in a table, all of them, and counted per user."""
    database, _ = _database(spark, "failures")
    table = f"{database}.orphan_events"
    odd = integrity.orphans(raw_events(spark, d), users(spark, d), "user_id")
    catalog.store_failures(odd.select("event_id", "user_id"), table)
    return spark.table(table).groupBy("user_id").agg(F.count("*").alias("failures"))


def appended_twice(spark: SparkSession, d: str) -> DataFrame:
    """The daily counts inserted twice without clearing: every day is doubled."""
    database, _ = _database(spark, "append")
    table = f"{database}.daily_summary"
    jobs.create_daily_summary(spark, table)
    ensure_checkpoints(spark)
    daily = views.daily_events(raw_events(spark, d)).checkpoint()
    catalog.append(daily, table)
    catalog.append(daily, table)
    return (
        spark.table(table)
        .groupBy("event_date")
        .agg(F.count("*").alias("copies"), F.sum("event_count").alias("event_count"))
    )


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    profiles = [
        profiling.value_counts(users(spark, d), ["plan_type", "country"], "users"),
        profiling.value_counts(sessions(spark, d), ["device_type"], "sessions"),
        profiling.value_counts(raw_events(spark, d), ["event_type", "device_type"], "raw_events"),
    ]
    first, second, third = profiles
    return first.union(second).union(third).orderBy("column_name", F.desc("n"))


def page_views_describe(spark: SparkSession, d: str) -> DataFrame:
    summary = profiling.describe(sessions(spark, d), "page_views")
    return summary.withColumn("mean", F.round("mean", 9)).withColumn("std", F.round("std", 9))


def _through_csv(spark: SparkSession, name: str, rows: DataFrame, schema, **how: str) -> DataFrame:
    path = scratch_path(spark, f"{name}_csv")
    csv_files.save_csv(rows, path, **how)
    return csv_files.load_csv(spark, path, schema)


def csv_load(spark: SparkSession, d: str) -> DataFrame:
    return _through_csv(spark, "users", users(spark, d), schemas.USERS)


def csv_load_sessions(spark: SparkSession, d: str) -> DataFrame:
    return _through_csv(spark, "sessions", sessions(spark, d), schemas.SESSIONS)


def csv_load_raw_events(spark: SparkSession, d: str) -> DataFrame:
    return _through_csv(spark, "raw_events", _events(spark, d), schemas.RAW_EVENTS, compression="gzip")


def csv_to_table(spark: SparkSession, d: str) -> DataFrame:
    """Gzip files of events loaded into a typed table, read back without its load time."""
    base, _ = _database(spark, "loaded")
    path = scratch_path(spark, "raw_events_csv")
    csv_files.save_csv(_events(spark, d), path, compression="gzip")
    table, audit = f"{base}.raw_events", schemas.AUDIT_COLUMN["raw_events"]
    csv_files.load_table(spark, path, table, schemas.RAW_EVENTS, audit, spread=True)
    return spark.table(table).drop(audit)


def clustered_recent_events(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "clustered_events")
    events = _events(spark, d)
    layout.write_events(events, path)
    return reports.recent_daily_events(layout.read_events(spark, path, events.schema), AS_OF)


def country_purchase_rate_by_day_table(spark: SparkSession, d: str) -> DataFrame:
    """The country report from lasting views over events laid out by day."""
    base, _ = _database(spark, "views")
    layout.save_events(_events(spark, d), f"{base}.raw_events")
    catalog.create_table(spark, f"{base}.users", schemas.USERS, schemas.AUDIT_COLUMN["users"])
    catalog.append(users(spark, d), f"{base}.users")
    views.create_views(spark, base, f"{base}.raw_events", f"{base}.users")
    return views.country_purchase_rate(spark.table(f"{base}.v_country_daily_summary"), AS_OF)


def clean_events(spark: SparkSession, d: str) -> DataFrame:
    """Events written as CSV, some spoilt and some twice, and what a cleaning load makes of them."""
    rows = _events(spark, d).withColumn(
        "event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss")
    )
    n = F.col("event_id")
    spoilt = rows.withColumns(
        {
            "user_id": F.when(n % 97 == 5, "nobody").otherwise(F.col("user_id").cast("string")),
            "event_timestamp": F.when(n % 89 != 7, F.col("event_timestamp")),
            "country": F.when(n % 83 == 3, "ZZZ").otherwise(F.col("country")),
        }
    )
    path = scratch_path(spark, "spoilt_csv")
    csv_files.save_csv(spoilt.unionAll(spoilt.where(n % 50 == 1)), path)
    accepted, rejected = clean_load.load_clean(spark, path, schemas.RAW_EVENTS, "event_id")
    refused = rejected.select("reason", F.split("line", ",")[0].cast("long").alias("event_id"))
    outcomes = accepted.select(F.lit("accepted").alias("reason"), "event_id").unionAll(refused)
    return outcomes.groupBy(F.col("reason").alias("outcome")).agg(
        F.count("*").alias("records"), F.sum("event_id").alias("event_ids")
    )


def _nightly(spark: SparkSession, d: str) -> dict[str, str]:
    """The nightly tables after two loads: the second brings the last days, and late events."""
    base, _ = _database(spark, "nightly")
    names = {t: f"{base}.{t}" for t in ("raw_events", "daily", "weekly", "active")}
    arrivals.create_arrivals(spark, names["raw_events"], schemas.RAW_EVENTS)
    nightly.create_nightly(spark, names["daily"], names["weekly"], names["active"])
    events = _events(spark, d)
    day = F.to_date("event_timestamp")
    is_late = (F.col("event_id") % 50 == 0) & day.between("2024-01-08", "2024-01-12")
    in_first = (day <= "2024-01-22") & ~is_late
    for load_id, rows in enumerate((events.where(in_first), events.where(~in_first)), start=1):
        arrivals.append_load(rows, names["raw_events"], load_id)
        nightly.run_nightly(spark, *names.values())
    return names


def nightly_daily(spark: SparkSession, d: str) -> DataFrame:
    return spark.table(_nightly(spark, d)["daily"]).drop("created_at")


def nightly_weekly(spark: SparkSession, d: str) -> DataFrame:
    return spark.table(_nightly(spark, d)["weekly"])


def nightly_active_users(spark: SparkSession, d: str) -> DataFrame:
    return spark.table(_nightly(spark, d)["active"])


def _user_states(spark: SparkSession, d: str) -> DataFrame:
    """The daily states of users, stored as a table as a nightly job would keep them."""
    base, _ = _database(spark, "states")
    states = activity.user_states(raw_events(spark, d), users(spark, d))
    catalog.materialize(states, f"{base}.user_states", "table")
    return spark.table(f"{base}.user_states")


QUERIES: dict[str, Query] = {
    "event_sample": event_sample,
    "purchases_in_countries": purchases_in_countries,
    "event_types": lambda s, d: exploration.event_types(raw_events(s, d)),
    "purchases_with_user": purchases_with_user,
    "orphan_events": lambda s, d: exploration.orphan_events(raw_events(s, d), users(s, d)),
    "daily_event_counts": lambda s, d: exploration.daily_event_counts(raw_events(s, d)),
    "country_funnel": lambda s, d: exploration.country_funnel(raw_events(s, d), users(s, d)),
    "heavy_users": lambda s, d: exploration.heavy_users(raw_events(s, d), min_events=75),
    "recent_daily_events": lambda s, d: reports.recent_daily_events(raw_events(s, d), AS_OF),
    "daily_purchase_rate": lambda s, d: reports.daily_purchase_rate(raw_events(s, d)),
    "conversion_tiers": lambda s, d: reports.conversion_tiers(
        raw_events(s, d), users(s, d), AS_OF, days=14
    ),
    "v_daily_events": v_daily_events,
    "v_daily_events_recent": lambda s, d: views.recent_days(v_daily_events(s, d), AS_OF),
    "v_country_daily_summary": v_country_daily_summary,
    "country_purchase_rate": lambda s, d: views.country_purchase_rate(
        v_country_daily_summary(s, d), AS_OF
    ),
    "refresh_daily_summary": refresh_daily_summary,
    "weekly_summary": weekly_summary,
    "stg_events": lambda s, d: models.stg_events(raw_events(s, d)),
    "stg_users": lambda s, d: models.stg_users(users(s, d)),
    "daily_summary": lambda s, d: models.model_frames(raw_events(s, d), users(s, d))["daily_summary"],
    "model_build": model_build,
    "model_build_checks": model_build_checks,
    "table_row_counts": lambda s, d: load_verification.table_row_counts(
        users(s, d), sessions(s, d), raw_events(s, d)
    ),
    "users_read_back": lambda s, d: load_verification.read_back(users(s, d), "user_id"),
    "sessions_read_back": lambda s, d: load_verification.read_back(sessions(s, d), "session_id"),
    "orphaned_sessions": lambda s, d: load_verification.orphaned_sessions(sessions(s, d), users(s, d)),
    "orphaned_events": lambda s, d: load_verification.orphaned_events(raw_events(s, d), users(s, d)),
    "orphaned_events_by_session": lambda s, d: load_verification.orphaned_events_by_session(
        raw_events(s, d), sessions(s, d)
    ),
    "users_by_country": lambda s, d: load_verification.users_by_country(users(s, d)),
    "event_type_distribution": lambda s, d: load_verification.event_type_distribution(raw_events(s, d)),
    "top_users": lambda s, d: load_verification.top_users(raw_events(s, d)),
    "device_session_stats": lambda s, d: load_verification.device_session_stats(sessions(s, d)),
    "null_dates_check": lambda s, d: checks.null_count(
        v_daily_events(s, d), "event_date", "null_dates"
    ),
    "negative_counts_check": lambda s, d: checks.negative_count(
        v_daily_events(s, d), "event_count", "negative_counts"
    ),
    "model_checks": model_checks,
    "accepted_values_check": accepted_values_check,
    "accepted_plans_check": accepted_plans_check,
    "accepted_range_check": accepted_range_check,
    "stored_failures": stored_failures,
    "appended_twice": appended_twice,
    "value_counts": value_counts,
    "page_views_describe": page_views_describe,
    "csv_load": csv_load,
    "csv_load_sessions": csv_load_sessions,
    "csv_load_raw_events": csv_load_raw_events,
    "csv_to_table": csv_to_table,
    "clustered_recent_events": clustered_recent_events,
    "country_purchase_rate_by_day_table": country_purchase_rate_by_day_table,
    "clean_events": clean_events,
    "nightly_daily": nightly_daily,
    "nightly_weekly": nightly_weekly,
    "nightly_active_users": nightly_active_users,
    "gap_sessions": lambda s, d: gap_sessions(raw_events(s, d)),
    "session_summary": lambda s, d: session_summary(gap_sessions(raw_events(s, d))),
    "funnel_report": lambda s, d: funnel.country_steps(raw_events(s, d), users(s, d)),
    "monthly_kpi": lambda s, d: activity.monthly_kpi(_user_states(s, d)),
    "period_users": lambda s, d: activity.period_users(_user_states(s, d)),
    "active_users": lambda s, d: activity.window_users(raw_events(s, d)),
    "retention": lambda s, d: activity.retention(raw_events(s, d)),
    "dashboard": lambda s, d: activity.dashboard(raw_events(s, d), users(s, d)),
    "week_over_week": lambda s, d: activity.week_over_week(_user_states(s, d)),
}
