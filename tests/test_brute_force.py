"""Random small tables against brute force in Python."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import at, events, rows, users
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hitledger.operators.checks import unique
from hitledger.operators.profiling import describe, value_counts
from hitledger.plans import exploration, load_verification, models, reports, views

# Few ids and users, so that ids repeat, users are missing or there twice.
EVENT_ROWS = st.lists(
    st.tuples(
        st.integers(1, 6),
        st.one_of(st.none(), st.integers(1, 4)),
        st.sampled_from(["purchase", "page_view"]),
        st.sampled_from([at("2024-01-10"), at("2024-01-11"), None]),
    ),
    max_size=25,
)
USER_ROWS = st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["US", "jp", None])), max_size=6)
FEW = settings(
    max_examples=12,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def joined(event_rows, user_rows):
    """Brute-force inner join, grouped by day and country."""
    groups = defaultdict(list)
    for event in event_rows:
        for user_id, country in user_rows:
            if event[1] == user_id:
                groups[event[3] and event[3].date(), country].append(event)
    return groups


@FEW
@given(EVENT_ROWS, USER_ROWS)
def test_country_view_equals_brute_force(spark, event_rows, user_rows):
    expected = [
        (
            day,
            country,
            len(group),
            len({e[1] for e in group}),
            len({e[0] for e in group if e[2] == "purchase"}),
        )
        for (day, country), group in joined(event_rows, user_rows).items()
    ]
    view = views.country_daily_summary(events(spark, event_rows), users(spark, user_rows))
    assert rows(view) == sorted(expected, key=repr)


@FEW
@given(EVENT_ROWS, USER_ROWS)
def test_mart_equals_brute_force(spark, event_rows, user_rows):
    upper = [(u, c and c.upper()) for u, c in user_rows]
    expected = [
        (
            day,
            country,
            len(group),
            len({e[1] for e in group}),
            len([e for e in group if e[2] == "purchase"]),
        )
        for (day, country), group in joined(event_rows, upper).items()
    ]
    frames = models.model_frames(events(spark, event_rows), users(spark, user_rows))
    assert rows(frames["daily_summary"]) == sorted(expected, key=repr)


def by_day(event_rows):
    groups = defaultdict(list)
    for event in event_rows:
        groups[event[3] and event[3].date()].append(event)
    return groups


@FEW
@given(EVENT_ROWS)
def test_daily_view_and_rate_equal_brute_force(spark, event_rows):
    view, rates = [], []
    for day, group in by_day(event_rows).items():
        people = len({e[1] for e in group if e[1] is not None})
        names = len({f"session_{e[1]}" for e in group})
        bought = len([e for e in group if e[2] == "purchase"]) if day else 0
        view.append((day, len(group), people, names))
        # Half up on integers, as fractions of a few events have short ties.
        rate = (bought * 20_000 + len(group)) // (2 * len(group)) / 10_000
        rates.append((day, len(group), people, bought, rate))
    frame = events(spark, event_rows)
    assert rows(views.daily_events(frame)) == sorted(view, key=repr)
    assert rows(reports.daily_purchase_rate(frame)) == sorted(rates, key=repr)


@FEW
@given(EVENT_ROWS, USER_ROWS)
def test_orphans_and_funnel_equal_brute_force(spark, event_rows, user_rows):
    frame, members = events(spark, event_rows), users(spark, user_rows)
    known = {user_id for user_id, _ in user_rows}
    lost = [e for e in event_rows if e[1] not in known]
    assert rows(load_verification.orphaned_events(frame, members)) == [(len(lost),)]
    listed = exploration.orphan_events(frame, members, limit=100)
    assert rows(listed) == sorted(((e[0], e[1], None) for e in lost), key=repr)
    countries = defaultdict(list)
    for (_, country), group in joined(event_rows, user_rows).items():
        countries[country] += [e[2] for e in group]
    funnel = [
        (country, len(types), types.count("page_view"), types.count("purchase"))
        for country, types in countries.items()
    ]
    assert rows(exploration.country_funnel(frame, members)) == sorted(funnel, key=repr)


@FEW
@given(EVENT_ROWS)
def test_profiles_equal_brute_force(spark, event_rows):
    frame = events(spark, event_rows)
    expected = [
        (f"raw_events.{column}", str(value), n)
        for column, at_index in (("user_id", 1), ("event_type", 2))
        for value, n in Counter(e[at_index] for e in event_rows).items()
        if value is not None
    ]
    counted = value_counts(frame, ["user_id", "event_type"], "raw_events")
    assert rows(counted) == sorted(expected, key=repr)
    repeated = [(i, n) for i, n in Counter(e[0] for e in event_rows).items() if n > 1]
    assert rows(unique(frame, "event_id")) == sorted(repeated, key=repr)


@FEW
@given(st.lists(st.integers(0, 10**9), min_size=2, max_size=40))
def test_describe_equals_numpy(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "page_views bigint")
    (row,) = describe(frame, "page_views").collect()
    expected = [np.mean(values), np.std(values, ddof=1), *np.percentile(values, [25, 50, 75])]
    assert [row["mean"], row["std"], row.p25, row.p50, row.p75] == pytest.approx(expected, rel=1e-12)
    assert (row["count"], row["min"], row["max"]) == (len(values), min(values), max(values))
