"""The quality checks on frames that fail them."""

import pytest
from frames import at, events, rows, users

from hitledger.operators import checks
from hitledger.operators.checks import Check
from hitledger.plans import models, views

DAY = "2024-01-10"


@pytest.fixture(scope="module")
def dirty(spark):
    return events(
        spark,
        [
            (1, 1, "click", at(DAY)),
            (1, 2, "click", at(DAY)),
            (None, 1, "click", at(DAY)),
            (None, None, "error", at(DAY)),
            (2, 1, None, None),
        ],
    )


def test_not_null_lists_the_rows(dirty):
    assert checks.not_null(dirty, "event_id").count() == 2
    assert [r.event_id for r in checks.not_null(dirty, "event_timestamp").collect()] == [2]


def test_unique_ignores_null_and_counts_repeats(dirty):
    assert rows(checks.unique(dirty, "event_id")) == [(1, 2)]


def test_accepted_values_ignore_null(dirty):
    odd = checks.accepted_values(dirty, "event_type", ["click"])
    assert [r.event_type for r in odd.collect()] == ["error"]


def test_accepted_range_includes_its_bounds(spark):
    frame = spark.createDataFrame([(v,) for v in (-1, 0, 5, 6, None)], "event_count bigint")

    def outside(**bounds):
        return [r[0] for r in rows(checks.accepted_range(frame, "event_count", **bounds))]

    assert outside(low=0, high=5) == [-1, 6]
    assert outside(low=0) == [-1]
    assert outside(high=5) == [6]
    assert outside() == []


def test_negative_and_null_counts(spark):
    frame = spark.createDataFrame([(-1,), (3,), (None,)], "event_count bigint")
    assert rows(checks.negative_count(frame, "event_count", "negative_counts")) == [(1,)]
    assert rows(checks.null_count(frame, "event_count", "nulls")) == [(1,)]


def test_null_date_in_the_daily_view(dirty):
    assert rows(checks.null_count(views.daily_events(dirty), "event_date", "null_dates")) == [(1,)]


def test_row_counts(spark, dirty):
    members = users(spark, [(1, "US")])
    assert rows(checks.row_counts({"USERS": members, "RAW_EVENTS": dirty})) == [
        ("RAW_EVENTS", 5),
        ("USERS", 1),
    ]


def test_run_checks_reports_each_declared_check(spark, dirty):
    declared = [
        Check("events", "event_id", "unique"),
        Check("events", "event_id", "not_null"),
        Check("events", "event_type", "not_null"),
        Check("users", "user_id", "unique"),
    ]
    members = users(spark, [(1, "US"), (1, "JP"), (2, "US"), (2, "US"), (3, "US")])
    report = checks.run_checks({"events": dirty, "users": members}, declared)
    assert report.columns == ["model", "column_name", "check_name", "failures"]
    assert rows(report) == [
        ("events", "event_id", "not_null", 2),
        ("events", "event_id", "unique", 1),
        ("events", "event_type", "not_null", 1),
        ("users", "user_id", "unique", 2),
    ]


def test_report_counts_the_failing_rows(spark, dirty):
    frames = models.model_frames(dirty, users(spark, [(1, "us"), (1, "US"), (None, "JP")]))
    report = {tuple(r)[:3]: r.failures for r in checks.run_checks(frames, models.CHECKS).collect()}
    assert set(report) == set(map(tuple, models.CHECKS))
    for check in models.CHECKS:
        assert checks.failing_rows(frames[check.model], check).count() == report[check]
    assert report["stg_users", "user_id", "unique"] == 1
    assert report["stg_users", "user_id", "not_null"] == 1
    assert report["stg_events", "event_id", "not_null"] == 0
