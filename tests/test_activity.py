"""Sessions, funnels, states, windows and cohorts against plain versions on made-up events."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from frames import at, events, rows, users
from pyspark.sql import functions as F

from hitledger.operators import funnel
from hitledger.operators.sessions import gap_sessions, session_summary
from hitledger.plans import activity

START = dt.datetime(2023, 12, 20)
TYPES = ["page_view", "click", "purchase", "sign_up"]


def made_up(seed, n=600, people=12, days=40, step=60):
    """(id, user, type, time): a third of it one user's, times on a grid so that ties occur."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        user = 0 if i % 3 == 0 else draw.randrange(-2, people)
        time = START + dt.timedelta(seconds=step * draw.randrange(days * 86400 // step))
        out.append((i, user, draw.choice(TYPES), time))
    odd = [(n, None, "click", at("2024-01-01")), (n + 1, 3, "click", None), (n + 2, None, None, None)]
    return out + odd


def known(data):
    return [r for r in data if r[1] is not None and r[3] is not None]


def day(time):
    return time.date()


def monday(date):
    return date - dt.timedelta(days=date.weekday())


@pytest.mark.parametrize("gap", [60, 1800, 86400])
def test_sessions(spark, gap):
    data = made_up(gap, n=900, days=3) + [(5000, 4, "purchase", START), (5001, 4, "click", START + dt.timedelta(seconds=gap))]
    data += [(5002, 77, "click", START), (5003, 77, "click", START + dt.timedelta(seconds=gap, microseconds=1))]
    expected, by_user = [], defaultdict(list)
    for _, user, kind, time in known(data):
        by_user[user].append((time, kind))
    for user, own in by_user.items():
        sessions = []
        for time, kind in sorted(own):
            if not sessions or (time - sessions[-1][-1][0]) > dt.timedelta(seconds=gap):
                sessions.append([])
            sessions[-1].append((time, kind))
        for no, s in enumerate(sessions, start=1):
            kinds = Counter(k for _, k in s)
            seconds = (s[-1][0] - s[0][0]) // dt.timedelta(seconds=1)
            expected.append((user, no, s[0][0], s[-1][0], len(s), kinds["page_view"], kinds["purchase"], seconds))
    found = gap_sessions(events(spark, data).repartition(5), gap)
    assert rows(found) == sorted(expected, key=repr)
    summary = session_summary(found)
    total = {r.session_date: r.session_count for r in summary.collect()}
    assert total == Counter(day(s[2]) for s in expected)


def test_a_hot_user_is_bounded_by_time(spark):
    """Half a million events of one user within a day order no more than 48 rows."""
    data = spark.range(500_000).select(
        F.col("id").alias("event_id"),
        F.lit(1).cast("long").alias("user_id"),
        F.lit("page_view").alias("event_type"),
        F.timestamp_add("SECOND", F.col("id") % 86_400, F.lit("2024-01-01").cast("timestamp")).cast("timestamp_ntz").alias("event_timestamp"),
    )
    found = gap_sessions(data)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Below the window lies the roll-up by user and slot, combined on the map side.
    assert "partial_count" in plan.split("Window [")[-1]
    assert rows(found.select("session_no", "event_count")) == [(1, 500_000)]
    slots = data.groupBy("user_id", F.window("event_timestamp", "1800 seconds")).count()
    assert slots.count() == 48


def reached(own, limit):
    views = [t for t, k in own if k == "page_view"]
    pairs = [(v, c) for v in views for c, k in own if k == "click" and v < c <= v + limit]
    bought = any(k == "purchase" and c < p <= v + limit for v, c in pairs for p, k in own)
    return bool(views), bool(pairs), bought


@pytest.mark.parametrize("chunk", ["1 minute", "1 hour", "90 days"])
@pytest.mark.parametrize("limit", [1, 5])
def test_funnel_for_any_chunk(spark, chunk, limit):
    """Few events per user, so that all outcomes occur; ties in time never follow one another."""
    data = made_up(limit, n=500, people=150, days=12, step=3600)
    by_user = defaultdict(list)
    for _, user, kind, time in known(data):
        if kind in funnel.STEPS:
            by_user[user].append((time, kind))
    expected = [(u, *reached(own, dt.timedelta(days=limit))) for u, own in by_user.items()]
    assert len(set(e[1:] for e in expected)) == 4
    found = funnel.user_funnel(events(spark, data).repartition(4), limit_days=limit, chunk=chunk)
    assert rows(found) == sorted(expected, key=repr)


def test_funnel_ties_and_countries(spark):
    t = at("2024-01-01")
    later = [t + dt.timedelta(seconds=s) for s in range(4)]
    data = [
        (1, 1, "page_view", t), (2, 1, "click", t), (3, 1, "purchase", later[1]),
        (4, 2, "page_view", t), (5, 2, "click", later[1]), (6, 2, "purchase", later[1]),
        (7, 3, "page_view", t), (8, 3, "click", later[1]), (9, 3, "purchase", later[2]), (9, 3, "purchase", later[2]),
        (10, 4, "purchase", t), (11, 4, "click", later[1]), (12, 4, "page_view", later[2]),
        (13, 9, "page_view", t),
    ]
    people = users(spark, [(1, "US"), (2, "US"), (3, "JP"), (4, "JP"), (5, "DE")])
    assert rows(funnel.country_steps(events(spark, data), people)) == [("JP", 2, 1, 1), ("US", 2, 1, 0)]
    assert funnel.country_steps(events(spark, []), people).collect() == []


def member_events(data, people):
    home = dict(people)
    return [(day(t), k, u, home[u]) for _, u, k, t in known(data) if u in home]


def test_states_unite_to_exact_users(spark):
    """Ids beyond one bucket, negative ones included; figures come from the states alone."""
    data = [(i, u if u is None or u % 2 else u * 40_000, k, t) for i, u, k, t in made_up(8)]
    people = [(u, "US" if u % 3 else "JP") for u in {r[1] for r in data if r[1] is not None}]
    stored = activity.user_states(events(spark, data), users(spark, people))
    home = member_events(data, people)
    months, periods = defaultdict(list), defaultdict(list)
    for d, k, u, c in home:
        months[d.replace(day=1), c].append((k, u))
        for period, first in (("day", d), ("week", monday(d)), ("month", d.replace(day=1))):
            periods[period, first].append(u)
    expected = [
        (m, c, len(own), sum(k == "purchase" for k, _ in own), len({u for _, u in own}))
        for (m, c), own in months.items()
    ]
    assert rows(activity.monthly_kpi(stored).drop("purchase_rate")) == sorted(expected, key=repr)
    expected = [(*key, len(own), len(set(own))) for key, own in periods.items()]
    assert rows(activity.period_users(stored)) == sorted(expected, key=repr)


def test_states_of_replaced_days(spark):
    """A day's state is replaced alone; the month follows without the other days' events."""
    people = users(spark, [(u, "US") for u in range(20)])
    first = events(spark, [(i, i % 7, "click", at(f"2024-01-0{1 + i % 3}")) for i in range(30)])
    late = events(spark, [(i, 10 + i % 5, "click", at("2024-01-02")) for i in range(9)])
    states = activity.user_states(first, people)
    day_two = activity.user_states(first.unionAll(late).where(F.to_date("event_timestamp") == "2024-01-02"), people)
    mended = states.where("event_date <> '2024-01-02'").unionAll(day_two)
    whole = activity.user_states(first.unionAll(late), people)
    assert rows(activity.monthly_kpi(mended)) == rows(activity.monthly_kpi(whole))


@pytest.mark.parametrize("windows", [(1, 7, 30), (3,)])
def test_window_users(spark, windows):
    data = made_up(21, n=150, days=60)
    active = {(u, day(t)) for _, u, _, t in known(data)}
    days = sorted(d for _, d in active)
    expected = []
    for i in range((days[-1] - days[0]).days + 1):
        now = days[0] + dt.timedelta(days=i)
        for w in windows:
            expected.append((now, w, len({u for u, d in active if 0 <= (now - d).days < w})))
    assert rows(activity.window_users(events(spark, data), windows)) == sorted(expected, key=repr)


def test_no_copy_per_day_of_a_window(spark):
    """Two changes per user-day and window, combined before they are shuffled."""
    plan = activity.window_users(events(spark, made_up(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate inline") == 1 and "partial_sum(change" in plan


def test_retention(spark):
    data = [r for r in made_up(4, n=260, people=60, days=70) if r[1] != 5 or r[3] is None]
    weeks = defaultdict(set)
    for _, u, _, t in known(data):
        weeks[u].add(monday(day(t)))
    newest = max(max(w) for w in weeks.values())
    expected = []
    for cohort in {min(w) for w in weeks.values()}:
        own = [w for w in weeks.values() if min(w) == cohort]
        for no in range((newest - cohort).days // 7 + 1):
            now = cohort + dt.timedelta(days=7 * no)
            here = [w for w in own if now in w]
            back = [w for w in here if no and now - dt.timedelta(days=7) not in w]
            gone = [w for w in own if max(w) < now]
            expected.append((cohort, no, len(own), len(here), len(back), len(gone)))
    found = activity.retention(events(spark, data))
    assert rows(found.drop("retention")) == sorted(expected, key=repr)
    assert found.where("week_no = 0 and retention <> 1").count() == 0


def test_week_over_week_fills_pauses(spark):
    """Two quiet weeks: 0, then a rise without a rate."""
    data = [(1, 1, "click", at("2024-01-01")), (2, 1, "click", at("2024-01-24")), (3, 2, "click", at("2024-01-09"))]
    states = activity.user_states(events(spark, data), users(spark, [(1, "US"), (2, "JP")]))
    found = rows(activity.week_over_week(states).where("country = 'US'").drop("country"))
    weeks = [dt.date(2024, 1, d) for d in (1, 8, 15, 22)]
    assert sorted(found) == [
        (weeks[0], 1, 1, None, None, None),
        (weeks[1], 0, 0, 1, -1, -1.0),
        (weeks[2], 0, 0, 0, 0, None),
        (weeks[3], 1, 1, 0, 1, None),
    ]


def test_dashboard_tells_missing_keys_from_totals(spark):
    data = made_up(13, n=200)
    people = [(u, [None, "US", "JP"][u % 3], ["free", None][u % 2]) for u in range(-2, 9)]
    home = {u: (c, p) for u, c, p in people}
    own = [(u, day(t), *home[u], k) for _, u, k, t in known(data) if u in home]
    levels = defaultdict(list)
    for u, d, c, p, k in own:
        for key in (("day", d, None, None), ("country", None, c, None), ("plan", None, None, p), ("total", None, None, None)):
            levels[key].append((u, k))
    expected = [
        (*key, len(rows_), sum(k == "purchase" for _, k in rows_), len({u for u, _ in rows_}))
        for key, rows_ in levels.items()
    ]
    found = activity.dashboard(events(spark, data), users(spark, people)).drop("purchase_rate")
    assert rows(found) == sorted(expected, key=repr)


def test_empty_tables(spark):
    none, nobody = events(spark, []), users(spark, [])
    states = activity.user_states(none, nobody)
    for frame in (
        gap_sessions(none),
        session_summary(gap_sessions(none)),
        activity.monthly_kpi(states),
        activity.period_users(states),
        activity.week_over_week(states),
        activity.window_users(none),
        activity.retention(none),
        activity.dashboard(none, nobody),
    ):
        assert frame.collect() == []
