"""What has to hold at scale: plan shapes, pruning, and hot keys."""

import re
from contextlib import contextmanager

import pytest
from frames import plan_of, rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from hitledger import registry
from hitledger.operators.rollups import daily_by_user_columns
from hitledger.plans import exploration, load_verification, models

SF_DIR = "/root/testdata/sf0.01"
# Plan nodes that do not scale, or that leave the JVM.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window", "ExistingRDD"]
# Windows over rows that are rolled up first, by what they are partitioned by.
WINDOWED = {
    "gap_sessions": {"user_id"},
    "session_summary": {"user_id"},
    "active_users": {"user_id", "window_days"},
    "retention": {"user_id", "cohort_week"},
    "week_over_week": {"country"},
}


@contextmanager
def conf(spark, **settings):
    """Settings for a block; `__` stands for the dots of a key."""
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles(plan):
    return plan.count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_plans_stay_distributed(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert not [node for node in UNWANTED if node in plan and (node != "Window" or name not in WINDOWED)]
    # Every window has a key, and sorts what an aggregate has made of the events.
    windows = re.findall(r"Window \[.*\], \[(\w+)#\d+L?\](?:, \[.*\])?\n", plan)
    assert plan.count("Window [") == len(windows) and set(windows) == WINDOWED.get(name, set())
    assert not windows or "HashAggregate" in plan.split("Window [")[-1]
    # Without statistics to allow it, nothing may be broadcast by a hint.
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(contract.queries()[name](spark, SF_DIR))
        if name == "event_sample":
            # The ten users of the sample, bounded by its limit, look up their countries:
            # only the customers they find are dealt out.
            assert plan.count("BroadcastExchange") == 1
            assert plan.index("LeftSemi") > plan.index("LeftOuter")
        else:
            assert "BroadcastExchange" not in plan


@pytest.mark.parametrize(
    "name, pushed, columns",
    [
        ("recent_daily_events", "GreaterThanOrEqual(ts,2024-01-23T00:00)", "ts,user_id"),
        ("v_daily_events_recent", "GreaterThanOrEqual(ts,2024-01-23T00:00)", "ts,user_id"),
        ("conversion_tiers", "GreaterThanOrEqual(ts,2024-01-16T00:00)", "event_id,ts,user_id,event_type"),
        ("country_purchase_rate", "GreaterThanOrEqual(ts,2024-01-23T00:00)", "event_id,ts,user_id,event_type"),
        ("purchases_with_user", "EqualTo(event_type,purchase)", "event_id,ts,user_id,event_type"),
        ("stg_events", "IsNotNull(event_id), IsNotNull(user_id)", "event_id,ts,user_id,event_type"),
        ("orphaned_events", "", "user_id"),
        ("event_types", "", "event_type"),
        ("daily_event_counts", "", "ts,user_id"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, columns):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    bare = [line.replace("#", "") for line in scans]
    (events_scan,) = [line for line in bare if "events.parquet" in line]
    assert pushed in events_scan
    read = events_scan.split("FileScan parquet [")[1].split("]")[0]
    assert [c.rstrip("0123456789L") for c in read.split(",")] == columns.split(",")


def test_sample_reads_whole_rows_below_a_bound_only(spark):
    sample = exploration.event_sample(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    assert "LessThanOrEqual(event_id,ScalarSubquery" in plan_of(sample)


def test_join_reuses_the_shuffle_of_the_counts(spark):
    """One shuffle per join side and one per final grouping."""
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert shuffles(plan_of(contract.queries()["country_funnel"](spark, SF_DIR))) == 3
        assert shuffles(plan_of(contract.queries()["orphaned_events"](spark, SF_DIR))) == 2


def test_mart_deals_out_its_users_once(spark):
    """Days of users, their join and the groups of the mart; the users only once."""
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert shuffles(plan_of(contract.queries()["daily_summary"](spark, SF_DIR))) == 4


def test_orphans_use_an_anti_join(spark):
    plan = plan_of(contract.queries()["orphan_events"](spark, SF_DIR))
    assert "LeftAnti" in plan and "LeftOuter" not in plan


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """90,000 events of which one user has a third, and purchases likewise."""
    folder = tmp_path_factory.mktemp("skewed")
    key = F.col("id")
    spark.range(90_000, numPartitions=8).select(
        key.alias("event_id"),
        F.when(key % 3 == 0, 7).otherwise(key % 4_001).cast("bigint").alias("user_id"),
        F.concat(F.lit("session_"), (key % 9_001).cast("string")).alias("session_id"),
        F.when(key % 2 == 0, "purchase").otherwise("click").alias("event_type"),
        F.timestamp_seconds(F.lit(1_704_067_200) + key * 10).cast("timestamp_ntz").alias("event_timestamp"),
    ).write.parquet(f"{folder}/events")
    spark.range(3_500).select(
        key.alias("user_id"),
        F.to_date(F.lit("2024-01-01")).alias("signup_date"),
        F.when(key % 2 == 0, "US").otherwise("JP").alias("country"),
        F.lit("free").alias("plan_type"),
        F.lit(True).alias("is_active"),
    ).write.parquet(f"{folder}/users")
    return spark.read.parquet(f"{folder}/events"), spark.read.parquet(f"{folder}/users")


# Thresholds scaled down to the size of the fixture.
SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20kb",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20kb",
    "spark__sql__adaptive__coalescePartitions__minPartitionSize": "1kb",
}


def final_plan(df):
    df.collect()
    return plan_of(df)


def test_hot_user_is_split_in_row_level_joins(spark, skewed):
    events, users = skewed
    with conf(spark, **SMALL):
        joined = exploration.purchases_with_user(events, users)
        assert "skew=true" in final_plan(joined)
        orphaned = exploration.orphan_events(events, users)
        assert "skew=true" in final_plan(orphaned)
        enriched = events.join(users.select("user_id", "country"), "user_id", "left")
        assert "skew=true" in final_plan(exploration.purchases_in_countries(enriched))
        purchases = daily_by_user_columns(events, users, ["country"])
        assert "skew=true" in final_plan(purchases)


def test_hot_user_collapses_before_the_mart_join(spark, skewed):
    events, users = skewed
    with conf(spark, **SMALL):
        mart = models.model_frames(events, users)["daily_summary"]
        assert "skew=true" not in final_plan(mart)


def test_results_do_not_depend_on_the_hot_key_plan(spark, skewed):
    """The same rows by the plain joins and groupings."""
    events, users = skewed
    joined = events.join(users.select("user_id", "country"), "user_id")
    day = F.to_date("event_timestamp").alias("event_date")
    bought = F.col("event_type") == "purchase"
    plain_mart = joined.groupBy(day, "country").agg(
        F.count("*"), F.countDistinct("user_id"), F.count_if(bought)
    )
    plain_view = joined.groupBy(day, "country").agg(
        F.count("*"), F.countDistinct("user_id"), F.countDistinct(F.when(bought, F.col("event_id")))
    )
    expected_mart, expected_view = rows(plain_mart), rows(plain_view)
    lost = events.join(users, "user_id", "left").filter(users.country.isNull()).count()
    with conf(spark, **SMALL):
        assert rows(models.model_frames(events, users)["daily_summary"]) == expected_mart
        assert rows(daily_by_user_columns(events, users, ["country"])) == expected_view
        assert rows(load_verification.orphaned_events(events, users)) == [(lost,)]
