"""Active users by period, window and cohort, from rows that are rolled up per user and day first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.functions.calendar import week_start, with_event_date
from hitledger.functions.measures import is_type, ratio

WINDOWS = (1, 7, 30)


def _of_users(events: DataFrame) -> DataFrame:
    """Events with their day that have both a user and a time."""
    dated = with_event_date(events)
    return dated.where(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())


# Mergeable states


def user_states(events: DataFrame, users: DataFrame) -> DataFrame:
    """Per day, country and bucket of user ids: events, purchases, and the users as a bit map.

    The bit maps of several days unite to the users of all of them, so any longer period is
    counted exactly from these rows without reading an event again, and a day that changes is
    replaced alone. A bucket covers 32,768 ids in at most 4 kB. Events are rolled up per user and
    day before they meet the users, as in the daily mart; those without a time have no state.
    """
    user_days = (
        _of_users(events)
        .groupBy("event_date", "user_id")
        .agg(F.count("*").alias("events"), F.count_if(is_type("purchase")).alias("purchases"))
    )
    return (
        user_days.join(users.select("user_id", "country"), "user_id")
        .groupBy("event_date", "country", F.bitmap_bucket_number("user_id").alias("bucket"))
        .agg(
            F.sum("events").alias("event_count"),
            F.sum("purchases").alias("purchase_count"),
            F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"),
        )
    )


def united(states: DataFrame, *keys: Column) -> DataFrame:
    """Events, purchases and exact distinct users per key, from the states of any days."""
    names = [f"key{i}" for i in range(len(keys))]
    named = [k.alias(n) for k, n in zip(keys, names, strict=True)]
    buckets = states.groupBy(*named, "bucket").agg(
        F.sum("event_count").alias("event_count"),
        F.sum("purchase_count").alias("purchase_count"),
        F.bitmap_or_agg("users").alias("users"),
    )
    return buckets.groupBy(*names).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("purchase_count").alias("purchase_count"),
        F.sum(F.bitmap_count("users")).alias("active_users"),
    )


def monthly_kpi(states: DataFrame) -> DataFrame:
    """Per month and country: events, purchases, users, and purchases per user."""
    month = F.trunc("event_date", "MONTH")
    figures = united(states, month, F.col("country"))
    return figures.select(
        F.col("key0").alias("month_start"),
        F.col("key1").alias("country"),
        "event_count",
        "purchase_count",
        "active_users",
        ratio(F.col("purchase_count"), F.col("active_users"), 4).alias("purchase_rate"),
    )


def period_users(states: DataFrame) -> DataFrame:
    """Events and users of every day, week and month, from one reading of the states.

    Days are united into weeks and months side by side; a day's bit maps go once into each.
    """
    periods = F.array(
        F.struct(F.lit("day").alias("period"), F.col("event_date").alias("start")),
        F.struct(F.lit("week").alias("period"), week_start(F.col("event_date")).alias("start")),
        F.struct(F.lit("month").alias("period"), F.trunc("event_date", "MONTH").alias("start")),
    )
    within = states.withColumn("within", F.explode(periods))
    return united(within, F.col("within.period"), F.col("within.start")).select(
        F.col("key0").alias("period"),
        F.col("key1").alias("period_start"),
        "event_count",
        "active_users",
    )


# Overlapping windows


def window_users(events: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """For every day from the first to the last: distinct users of its last 1, 7 and 30 days.

    A user-day counts from that day on, until the window has passed or the user's next day takes
    over. These spans of a user do not overlap, so their starts less their ends, added up along
    the calendar, are the distinct users: two changes for each user-day and window, instead of a
    copy for each of the days that it counts for. Days without events are counted too.
    """
    dated = _of_users(events)
    user_days = dated.select("user_id", "event_date").distinct()
    following = F.lead("event_date").over(Window.partitionBy("user_id").orderBy("event_date"))
    ends = [F.least(F.date_add("event_date", w), F.col("following")) for w in windows]
    # `least` passes over a missing next day.
    changes = F.array(
        *[
            F.struct(F.lit(w).alias("window_days"), day.alias("day"), F.lit(by).cast("long").alias("change"))
            for w, end in zip(windows, ends, strict=True)
            for day, by in ((F.col("event_date"), 1), (end, -1))
        ]
    )
    per_day = (
        user_days.withColumn("following", following)
        .select(F.inline(changes))
        .groupBy("window_days", "day")
        .agg(F.sum("change").alias("change"))
    )
    first = dated.agg(F.min("event_date")).scalar()
    last = dated.agg(F.max("event_date")).scalar()
    calendar = (
        events.sparkSession.range(1)
        .select(F.explode(F.sequence(first, last)).alias("day"))
        .withColumn("window_days", F.explode(F.array(*map(F.lit, windows))))
    )
    along = Window.partitionBy("window_days").orderBy("day")
    total = F.sum(F.coalesce("change", F.lit(0).cast("long"))).over(along)
    return calendar.join(per_day, ["window_days", "day"], "left").select(
        F.col("day").alias("event_date"), "window_days", total.alias("active_users")
    )


# Cohorts


def retention(events: DataFrame) -> DataFrame:
    """The retention triangle: users by the week of their first event, followed week by week.

    `active_users` of the cohort have an event in the week, `returned_users` are those of them
    that had none in the week before, `churned_users` have none in this week nor later. Weeks
    without any of them show 0, up to the last week with events. A user is reduced to weeks before
    anything is ordered.
    """
    dated = _of_users(events)
    week = week_start(F.col("event_date"))
    user_weeks = dated.select("user_id", week.alias("week")).distinct()
    per_user = Window.partitionBy("user_id")
    in_time = per_user.orderBy("week")
    number = (F.datediff("week", "cohort_week") / 7).cast("int")
    marked = user_weeks.select(
        "week",
        F.min("week").over(per_user).alias("cohort_week"),
        F.lag("week").over(in_time).alias("before"),
        F.lead("week").over(in_time).alias("after"),
    ).select(
        "cohort_week",
        number.alias("week_no"),
        (F.datediff("week", "before") > 7).alias("returned"),
        F.col("after").isNull().alias("last"),
    )
    counted = marked.groupBy("cohort_week", "week_no").agg(
        F.count("*").alias("active_users"),
        F.count_if("returned").alias("returned_users"),
        F.count_if("last").alias("left_users"),
    )
    # One row per cohort, its weeks as a map; the calendar's last week closes them all.
    newest = dated.agg(F.max(week)).scalar()
    figures = F.struct("active_users", "returned_users", "left_users")
    cohorts = counted.groupBy("cohort_week").agg(
        F.map_from_entries(F.collect_list(F.struct("week_no", figures))).alias("weeks")
    )
    numbers = F.sequence(F.lit(0), (F.datediff(newest, "cohort_week") / 7).cast("int"))
    figure = lambda of, name: F.coalesce(F.try_element_at("weeks", of)[name], F.lit(0).cast("long"))
    filled = cohorts.select("cohort_week", "weeks", F.explode(numbers).alias("week_no")).select(
        "cohort_week",
        "week_no",
        figure(F.lit(0), "active_users").alias("cohort_size"),
        *[figure(F.col("week_no"), n).alias(n) for n in ("active_users", "returned_users", "left_users")],
    )
    earlier = (
        Window.partitionBy("cohort_week")
        .orderBy("week_no")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return filled.select(
        "cohort_week",
        "week_no",
        "cohort_size",
        "active_users",
        "returned_users",
        F.coalesce(F.sum("left_users").over(earlier), F.lit(0).cast("long")).alias("churned_users"),
        ratio(F.col("active_users"), F.col("cohort_size"), 4).alias("retention"),
    )


# Weeks side by side


def week_over_week(states: DataFrame) -> DataFrame:
    """Events and users per week and country, and the change against the calendar's week before.

    Every country has all weeks from the first to the last of the table; a week without events
    shows 0, so a change never jumps over a pause. The rate is null after a week without events.
    """
    weekly = united(states, week_start(F.col("event_date")), F.col("country")).withColumnsRenamed(
        {"key0": "week_start", "key1": "country"}
    )
    # The span of the table rides along as an array of at most some thousand weeks.
    span = weekly.agg(
        F.sequence(F.min("week_start"), F.max("week_start"), F.expr("INTERVAL 7 DAYS")).alias("weeks"),
        F.collect_set("country").alias("countries"),
    )
    calendar = span.select("weeks", F.explode("countries").alias("country")).select(
        "country", F.explode("weeks").alias("week_start")
    )
    filled = calendar.join(weekly, ["country", "week_start"], "left").na.fill(0)
    in_time = Window.partitionBy("country").orderBy("week_start")
    before, now = F.col("previous_count"), F.col("event_count")
    return filled.select(
        "week_start",
        "country",
        "event_count",
        "active_users",
        F.lag("event_count").over(in_time).alias("previous_count"),
    ).select(
        "*",
        (now - before).alias("change"),
        F.when(before > 0, ratio(now - before, before, 4)).alias("change_rate"),
    )


# Levels side by side


def dashboard(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events, purchases and exact distinct users by day, by country, by plan, and in total.

    All levels come from one reading of the events: rolled up per user and day, they meet the
    users once, and each of these rows goes into every level, combined before the shuffle. `level`
    names the level, so a missing country or plan of a user is a row of its own (NULL in that
    level) and is not mistaken for a total.
    """
    user_days = (
        _of_users(events)
        .groupBy("event_date", "user_id")
        .agg(F.count("*").alias("events"), F.count_if(is_type("purchase")).alias("purchases"))
    )
    homes = users.select("user_id", "country", "plan_type")
    keys = [F.col("event_date"), F.col("country"), F.col("plan_type")]
    levels = user_days.join(homes, "user_id").groupingSets([[k] for k in keys] + [[]], *keys)
    summed = levels.agg(
        F.grouping("event_date").alias("no_day"),
        F.grouping("country").alias("no_country"),
        F.grouping("plan_type").alias("no_plan"),
        F.sum("events").alias("event_count"),
        F.sum("purchases").alias("purchase_count"),
        F.countDistinct("user_id").alias("active_users"),
    )
    level = (
        F.when(F.col("no_day") == 0, "day")
        .when(F.col("no_country") == 0, "country")
        .when(F.col("no_plan") == 0, "plan")
        .otherwise("total")
    )
    return summed.where("active_users > 0").select(
        level.alias("level"),
        "event_date",
        "country",
        "plan_type",
        "event_count",
        "purchase_count",
        "active_users",
        ratio(F.col("purchase_count"), F.col("active_users"), 4).alias("purchase_rate"),
    )
