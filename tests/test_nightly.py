"""The incremental nightly job against a rebuild from all events."""

import datetime as dt
import random
import uuid

import pytest
from frames import at, events, rows
from pyspark.sql import functions as F

from hitledger import schemas
from hitledger.plans import nightly
from hitledger.plans.jobs import weekly_summary
from hitledger.sources import arrivals, catalog

DAILY = ["event_date", "event_count", "unique_users", "unique_sessions", "last_load"]


@pytest.fixture
def tables(spark):
    base = f"nightly_{uuid.uuid4().hex}"
    catalog.create_database(spark, base)
    names = [f"{base}.{t}" for t in ("events", "daily", "weekly", "active")]
    arrivals.create_arrivals(spark, names[0], schemas.RAW_EVENTS)
    nightly.create_nightly(spark, *names[1:])
    yield names
    spark.sql(f"DROP DATABASE {base} CASCADE")


def some(spark, seed, days, n=200, users=9):
    draw = random.Random(seed)
    made = []
    for i in range(n):
        time = at(draw.choice(days), f"{draw.randrange(24):02}:{draw.randrange(60):02}:00")
        made.append((seed * 1000 + i, draw.randrange(users), "click", time, f"s{draw.randrange(40)}"))
    return events(spark, made)


def state(spark, tables):
    return [rows(spark.table(t).drop("created_at")) for t in tables[1:]]


def rebuilt(spark, tables, days=nightly.ACTIVE_DAYS):
    """The three tables from all events at once."""
    all_events = spark.table(tables[0])
    daily = nightly.daily_counts(all_events)
    newest = all_events.agg(F.max("event_date")).first()[0]
    recent = all_events.where(F.col("event_date") > newest - dt.timedelta(days=days))
    return [
        rows(daily.select(*DAILY)),
        rows(weekly_summary(daily)),
        rows(nightly.active_users(recent)),
    ]


def test_new_and_late_events_equal_a_rebuild(spark, tables):
    old = ["2023-12-28", "2023-12-31", "2024-01-01", "2024-01-02", "2024-01-20"]
    arrivals.append_load(some(spark, 1, old), tables[0], 1)
    assert nightly.run_nightly(spark, *tables) == {dt.date.fromisoformat(d) for d in old}
    assert state(spark, tables) == rebuilt(spark, tables)

    late = ["2023-12-31", "2024-02-05"]
    arrivals.append_load(some(spark, 2, late, 30), tables[0], 4)
    arrivals.append_load(some(spark, 3, ["2024-01-02"], 3, users=99), tables[0], 5)
    assert nightly.run_nightly(spark, *tables) == {
        dt.date(2023, 12, 31), dt.date(2024, 1, 2), dt.date(2024, 2, 5)
    }
    assert state(spark, tables) == rebuilt(spark, tables)
    assert nightly.high_water_mark(spark, tables[1]) == 5


def test_untouched_days_keep_their_load_time(spark, tables):
    arrivals.append_load(some(spark, 1, ["2024-01-01", "2024-01-02"]), tables[0], 1)
    nightly.run_nightly(spark, *tables)
    before = {r.event_date: r.created_at for r in spark.table(tables[1]).collect()}
    arrivals.append_load(some(spark, 2, ["2024-01-02"], 5), tables[0], 2)
    nightly.run_nightly(spark, *tables)
    after = {r.event_date: r.created_at for r in spark.table(tables[1]).collect()}
    assert after[dt.date(2024, 1, 1)] == before[dt.date(2024, 1, 1)]
    assert after[dt.date(2024, 1, 2)] > before[dt.date(2024, 1, 2)]


def test_only_touched_days_are_read(spark, tables):
    arrivals.append_load(some(spark, 1, ["2024-01-01", "2024-01-02", "2024-01-03"]), tables[0], 1)
    arrivals.append_load(some(spark, 2, ["2024-01-02"], 5), tables[0], 2)
    days = arrivals.touched_days(spark, tables[0], 1)
    assert days == {dt.date(2024, 1, 2)}
    read = arrivals.events_of(spark, tables[0], days)
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in scan
    found = {r[0].split("/event_date=")[1][:10] for r in read.select(F.input_file_name()).distinct().collect()}
    assert found == {"2024-01-02"}


def test_no_new_load_changes_nothing(spark, tables):
    assert nightly.run_nightly(spark, *tables) == set()
    arrivals.append_load(some(spark, 1, ["2024-01-01"]), tables[0], 1)
    nightly.run_nightly(spark, *tables)
    places = [catalog._location(spark, t) for t in tables[1:]]
    assert nightly.run_nightly(spark, *tables) == set()
    assert [catalog._location(spark, t) for t in tables[1:]] == places


@pytest.mark.parametrize("step", ["weekly_summary", "active_users", "switch_to"])
def test_a_failed_run_changes_nothing(spark, tables, monkeypatch, step):
    arrivals.append_load(some(spark, 1, ["2024-01-01", "2024-01-09"]), tables[0], 1)
    nightly.run_nightly(spark, *tables)
    before = state(spark, tables)
    arrivals.append_load(some(spark, 2, ["2024-01-09", "2024-01-10"]), tables[0], 2)

    def fail(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(nightly, step, fail)
        with pytest.raises(RuntimeError):
            nightly.run_nightly(spark, *tables)
    assert state(spark, tables) == before
    assert nightly.high_water_mark(spark, tables[1]) == 1
    nightly.run_nightly(spark, *tables)
    assert state(spark, tables) == rebuilt(spark, tables)


def test_stopped_between_two_switches_is_repeated(spark, tables, monkeypatch):
    """The mark moves last, so the next run counts the same days again."""
    arrivals.append_load(some(spark, 1, ["2024-01-01"]), tables[0], 1)

    def half(spark, folders):
        first = next(iter(folders))
        catalog.switch_to(spark, {first: folders[first]})
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(nightly, "switch_to", half)
        with pytest.raises(RuntimeError):
            nightly.run_nightly(spark, *tables)
    assert nightly.high_water_mark(spark, tables[1]) is None
    nightly.run_nightly(spark, *tables)
    assert state(spark, tables) == rebuilt(spark, tables)


def test_loads_come_in_order_and_fail_whole(spark, tables):
    arrivals.append_load(some(spark, 1, ["2024-01-01"]), tables[0], 3)
    with pytest.raises(ValueError):
        arrivals.append_load(some(spark, 2, ["2024-01-02"]), tables[0], 3)
    broken = some(spark, 2, ["2024-01-02"]).withColumn("country", F.raise_error(F.lit("bad")).cast("string"))
    with pytest.raises(Exception, match="bad"):
        arrivals.append_load(broken, tables[0], 4)
    assert {load for load, _ in arrivals.partitions(spark, tables[0])} == {3}


def test_events_without_a_time_form_a_day_of_their_own(spark, tables):
    timeless = events(spark, [(1, 1, "click", None), (2, 2, "click", at("2024-01-01"))])
    arrivals.append_load(timeless, tables[0], 1)
    nightly.run_nightly(spark, *tables)
    arrivals.append_load(events(spark, [(3, 1, "click", None)]), tables[0], 2)
    assert nightly.run_nightly(spark, *tables) == {None}
    counts = {r.event_date: r.event_count for r in spark.table(tables[1]).collect()}
    assert counts == {None: 2, dt.date(2024, 1, 1): 1}
