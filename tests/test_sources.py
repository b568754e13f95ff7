"""CSV, tables, views, layers and the event layout."""

import datetime as dt
import gzip

import pytest
from frames import at, events, plan_of, rows, users
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hitledger import registry, schemas
from hitledger.plans import jobs, models, reports, views
from hitledger.sources import catalog, csv_files, layout
from hitledger.sources import scratch
from hitledger.sources.driver_tables import AS_OF, raw_events, with_country
from hitledger.sources.driver_tables import users as driver_users
from hitledger.sources.scratch import ensure_checkpoints, scratch_path

SF_DIR = "/root/testdata/sf0.01"
DAY = dt.date(2024, 1, 10)
# A failing task surfaces as either, depending on where it was raised.
FAILED_JOB = (PySparkException, Py4JError)
HEADER = "USER_ID,SIGNUP_DATE,COUNTRY,PLAN_TYPE,IS_ACTIVE\n"
EVENT_HEADER = (
    "EVENT_ID,USER_ID,SESSION_ID,EVENT_TYPE,PAGE_URL,EVENT_TIMESTAMP,DEVICE_TYPE,COUNTRY\n"
)


@pytest.fixture
def base(spark, tmp_path):
    """A database of its own for each test."""
    name = f"t_{abs(hash(str(tmp_path)))}"
    catalog.create_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def users_file(tmp_path, *lines):
    path = tmp_path / "users.csv"
    path.write_text(HEADER + "".join(f"{line}\n" for line in lines))
    return str(path)


def test_csv_parses_types(spark, tmp_path):
    path = users_file(tmp_path, "1,2024-01-02,US,free,True", '"2",2024-01-03,"JP",premium,False')
    loaded = csv_files.load_csv(spark, path, schemas.USERS, audit_column="updated_at")
    assert loaded.columns == ["user_id", "signup_date", "country", "plan_type", "is_active", "updated_at"]
    assert rows(loaded.drop("updated_at")) == [
        (1, dt.date(2024, 1, 2), "US", "free", True),
        (2, dt.date(2024, 1, 3), "JP", "premium", False),
    ]
    assert loaded.filter("updated_at IS NULL").isEmpty()


def test_csv_gzip_quoted_comma_and_nulls(spark, tmp_path):
    path = str(tmp_path / "raw_events.csv.gz")
    with gzip.open(path, "wt") as out:
        out.write(EVENT_HEADER)
        out.write('1,7,s1,click,"/a,b ""c""",2024-01-10 08:09:10,mobile,US\n')
        out.write("2,7,s1,click,,2024-01-10 08:09:11,,\n")
        out.write('3,7,s1,click,"",2024-01-10 08:09:12, a ,US\n')
        out.write("4,7,s1,click,\\N,2024-01-10 08:09:13,tablet,\n")
    for spread in (False, True):
        loaded = csv_files.load_csv(spark, path, schemas.RAW_EVENTS, spread=spread)
        assert rows(loaded) == [
            (1, 7, "s1", "click", '/a,b "c"', at(DAY, "08:09:10"), "mobile", "US"),
            (2, 7, "s1", "click", None, at(DAY, "08:09:11"), None, None),
            (3, 7, "s1", "click", "", at(DAY, "08:09:12"), " a ", "US"),
            (4, 7, "s1", "click", None, at(DAY, "08:09:13"), "tablet", None),
        ]


def test_csv_field_over_two_lines(spark, tmp_path):
    path = tmp_path / "raw_events.csv"
    path.write_text(EVENT_HEADER + '1,7,s1,click,"/a\n/b",2024-01-10 08:09:10,mobile,US\n')
    loaded = csv_files.load_csv(spark, str(path), schemas.RAW_EVENTS, multiline=True)
    assert [r.page_url for r in loaded.collect()] == ["/a\n/b"]
    with pytest.raises(FAILED_JOB):
        csv_files.load_csv(spark, str(path), schemas.RAW_EVENTS).collect()


@pytest.mark.parametrize(
    "line",
    [
        "x,2024-01-02,US,free,True",
        "2,02/01/2024,US,free,True",
        "2,2024-01-02,US,free,maybe",
        "2,2024-01-02,US,free",
        "2,2024-01-02,US,free,True,more",
        "2,2024-01-02,,free,True",
        "2,2024-01-02,USA,free,True",
    ],
    ids=["integer", "date", "boolean", "short", "long", "required", "too-long"],
)
def test_bad_record_aborts_the_load(spark, tmp_path, base, line):
    path = users_file(tmp_path, "1,2024-01-02,US,free,True", line)
    table = f"{base}.users"
    catalog.create_table(spark, table, schemas.USERS, "updated_at")
    loaded = csv_files.load_csv(spark, path, schemas.USERS)
    for use in (
        lambda: loaded.count(),
        lambda: loaded.groupBy("plan_type").count().collect(),
        lambda: loaded.select("user_id").collect(),
        lambda: catalog.append(loaded, table),
        lambda: csv_files.load_table(spark, path, table, schemas.USERS, replace=True),
    ):
        with pytest.raises(FAILED_JOB):
            use()
    assert spark.table(table).count() == 0


def test_load_table_adds_or_replaces(spark, tmp_path, base):
    path = users_file(tmp_path, "1,2024-01-02,US,free,True")
    table = f"{base}.users"
    for replace, n in ((False, 1), (False, 2), (True, 1)):
        csv_files.load_table(spark, path, table, schemas.USERS, "updated_at", replace=replace)
        assert spark.table(table).count() == n
    assert spark.table(table).filter("updated_at IS NULL").isEmpty()


def test_csv_round_trip_keeps_whole_seconds(spark, tmp_path):
    frame = events(spark, [(1, 1, "click", dt.datetime(2024, 1, 10, 1, 2, 3, 999999))])
    csv_files.save_csv(frame.coalesce(1), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*.csv")
    assert file.read_text().splitlines() == [
        EVENT_HEADER.strip().lower(),
        "1,1,session_1,click,/home,2024-01-10 01:02:03,mobile,US",
    ]
    loaded = csv_files.load_csv(spark, str(tmp_path / "out"), schemas.RAW_EVENTS)
    assert [r.event_timestamp for r in loaded.collect()] == [at(DAY, "01:02:03")]


def test_csv_round_trip_keeps_odd_text(spark, tmp_path):
    texts = [None, "", " a ", 'say "hi"', "a,b", "\\", "\\n", "ü"]
    frame = events(spark, [(i, 1, "click", at(DAY)) for i in range(len(texts))])
    urls = spark.createDataFrame(list(enumerate(texts)), "event_id bigint, page_url string")
    frame = frame.drop("page_url").join(urls, "event_id").select(*schemas.RAW_EVENTS.names)
    csv_files.save_csv(frame, str(tmp_path / "out"))
    loaded = csv_files.load_csv(spark, str(tmp_path / "out"), schemas.RAW_EVENTS)
    assert rows(loaded) == rows(frame)


def test_create_table_is_typed_and_replaces(spark, base):
    table = f"{base}.users"
    for _ in range(2):
        catalog.create_table(spark, table, schemas.USERS, schemas.AUDIT_COLUMN["users"])
        catalog.append(users(spark, [(1, "US")]), table)
        assert spark.table(table).count() == 1
    types = dict(spark.table(table).dtypes)
    assert types.pop("updated_at") == "timestamp"
    assert types == {f.name: f.dataType.simpleString() for f in schemas.USERS.fields}
    assert spark.table(table).filter("updated_at IS NULL").isEmpty()


def test_append_goes_by_name(spark, base):
    table = f"{base}.daily"
    jobs.create_daily_summary(spark, table)
    day = spark.createDataFrame([(3, DAY)], "event_count bigint, event_date date")
    catalog.append(day, table)
    catalog.append(day, table)
    read = spark.table(table)
    assert rows(read.drop("created_at")) == [(DAY, 3, None, None)] * 2
    assert read.filter("created_at IS NULL").isEmpty()


def test_full_refresh_twice_gives_the_same_table(spark, base):
    table = f"{base}.daily"
    jobs.create_daily_summary(spark, table)
    raw = raw_events(spark, SF_DIR)
    jobs.refresh_daily_summary(raw, table)
    once = rows(spark.table(table).drop("created_at"))
    jobs.refresh_daily_summary(raw, table)
    assert rows(spark.table(table).drop("created_at")) == once == rows(views.daily_events(raw))
    latest = jobs.latest_days(spark.table(table)).collect()
    assert [r.event_date.day for r in latest] == list(range(30, 20, -1))


def test_full_refresh_may_read_its_own_table(spark, base):
    table = f"{base}.daily"
    jobs.create_daily_summary(spark, table)
    catalog.append(spark.createDataFrame([(DAY, 3)], "event_date date, event_count bigint"), table)
    doubled = spark.table(table).select("event_date", (F.col("event_count") * 2).alias("event_count"))
    catalog.full_refresh(doubled, table)
    assert rows(spark.table(table).select("event_date", "event_count")) == [(DAY, 6)]


def test_failed_refresh_keeps_the_old_rows(spark, base):
    table = f"{base}.daily"
    jobs.create_daily_summary(spark, table)
    old = spark.createDataFrame([(DAY, 3)], "event_date date, event_count bigint")
    catalog.append(old, table)
    broken = old.withColumn("event_count", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(FAILED_JOB):
        catalog.full_refresh(broken, table)
    assert rows(spark.table(table).select("event_date", "event_count")) == [(DAY, 3)]


def test_failed_materialize_keeps_the_old_rows(spark, base):
    table = f"{base}.mart"
    old = spark.range(5)
    catalog.materialize(old, table, "table")
    for broken in (
        old.select(F.raise_error(F.lit("broken")).cast("bigint").alias("id")),
        old.select(F.raise_error(F.lit("broken")).cast("int").alias("other")),
    ):
        with pytest.raises(FAILED_JOB):
            catalog.materialize(broken, table, "table")
        assert spark.table(table).count() == 5


def test_table_may_be_built_from_itself(spark, base):
    table = f"{base}.mart"
    catalog.materialize(spark.range(5), table, "table")
    catalog.materialize(spark.table(table).filter("id > 1"), table, "table")
    assert rows(spark.table(table)) == [(2,), (3,), (4,)]
    catalog.materialize(spark.table(table).selectExpr("id AS other"), table, "table")
    assert spark.table(table).columns == ["other"]
    (left,) = [f for f in (spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()) if f[0] == "Location"]
    assert spark.read.parquet(left[1]).count() == 3


def test_odd_column_names(spark, base):
    table = f"{base}.odd"
    odd = spark.createDataFrame([(1, 2)], "`a b` int, `c``d` int")
    catalog.materialize(odd, table, "table")
    catalog.append(odd, table)
    catalog.full_refresh(spark.table(table), table)
    assert rows(spark.table(table)) == [(1, 2), (1, 2)]


def test_model_as_view(spark):
    catalog.materialize(spark.range(3), "three", "view")
    assert spark.table("three").count() == 3


def test_refresh_refuses_unknown_columns(spark, base):
    table = f"{base}.daily"
    jobs.create_daily_summary(spark, table)
    with pytest.raises(ValueError):
        catalog.full_refresh(spark.range(1), table)


def test_failed_build_keeps_the_mart(spark, base, tmp_path):
    raw, members = raw_events(spark, SF_DIR), driver_users(spark, SF_DIR)
    for name, df in (("raw_events", raw), ("users", members)):
        catalog.materialize(df, f"{base}.{name}", "table")
    place = str(tmp_path / "layers")
    names = models.build_models(spark, base, f"{base}.raw_events", f"{base}.users", place)
    mart = rows(spark.table(names["daily_summary"]))
    folder = str(tmp_path / "broken")
    members.write.parquet(folder)
    for file in (tmp_path / "broken").glob("*.parquet"):
        file.write_bytes(b"not Parquet")
    spark.sql(f"ALTER TABLE {base}.users SET LOCATION '{folder}'")
    with pytest.raises(FAILED_JOB):
        models.build_models(spark, base, f"{base}.raw_events", f"{base}.users", place)
    assert rows(spark.table(names["daily_summary"])) == mart
    for name in ("staging", "marts"):
        spark.sql(f"DROP DATABASE {base}_{name} CASCADE")


def test_built_and_laid_out_tables_are_whole(spark, tmp_path):
    whole = with_country(spark, SF_DIR, raw_events(spark, SF_DIR))
    base, _, _ = registry._built(spark, SF_DIR, "whole")
    loaded = spark.table(f"{base}.raw_events").drop(schemas.AUDIT_COLUMN["raw_events"])
    assert rows(loaded.select(*whole.columns)) == rows(whole)
    path = str(tmp_path / "laid_out")
    layout.write_events(whole, path)
    assert rows(layout.read_events(spark, path, whole.schema).drop("event_date")) == rows(whole)


def test_frames_stay_readable_until_cleared(spark):
    first = registry.csv_load(spark, SF_DIR)
    second = registry.csv_load(spark, SF_DIR)
    mart = registry.model_build(spark, SF_DIR)
    registry.model_build(spark, SF_DIR)
    assert rows(first) == rows(second) and mart.count() > 0
    scratch.clear(spark)
    assert not spark.sql("SHOW DATABASES LIKE 'hitledger_*'").collect()
    with pytest.raises(FAILED_JOB):
        first.collect()


def test_weekly_refresh_does_not_repeat_weeks(spark, base):
    daily, weekly = f"{base}.daily", f"{base}.weekly"
    jobs.create_daily_summary(spark, daily)
    jobs.create_weekly_summary(spark, weekly)
    for _ in range(2):
        jobs.refresh_daily_then_weekly(raw_events(spark, SF_DIR), daily, weekly)
    assert spark.table(weekly).count() == 5
    assert spark.table(weekly).agg(F.sum("event_count")).first()[0] == 10_000


def test_view_is_run_again_on_each_read(spark, base):
    table = f"{base}.raw_events"
    catalog.create_table(spark, table, schemas.RAW_EVENTS, "created_at")
    catalog.register_view(views.daily_events(spark.table(table)), "v_daily_events")
    assert spark.table("v_daily_events").count() == 0
    catalog.append(events(spark, [(1, 1, "click", at(DAY))]), table)
    assert rows(spark.sql("SELECT * FROM v_daily_events")) == [(DAY, 1, 1, 1)]


@pytest.mark.parametrize("laid_out", [False, True])
def test_lasting_views_equal_the_frames(spark, base, laid_out):
    raw, members = raw_events(spark, SF_DIR), driver_users(spark, SF_DIR)
    if laid_out:
        layout.save_events(raw, f"{base}.raw_events")
    else:
        catalog.create_table(spark, f"{base}.raw_events", schemas.RAW_EVENTS, "created_at")
        catalog.append(raw, f"{base}.raw_events")
    catalog.create_table(spark, f"{base}.users", schemas.USERS, "updated_at")
    catalog.append(members, f"{base}.users")
    for _ in range(2):
        views.create_views(spark, base, f"{base}.raw_events", f"{base}.users")
    frames = {
        "v_daily_events": views.daily_events(raw),
        "v_country_daily_summary": views.country_daily_summary(raw, members),
    }
    for name, frame in frames.items():
        view = spark.table(f"{base}.{name}")
        assert view.dtypes == frame.dtypes
        assert rows(view) == rows(frame)
        pruned = "PartitionFilters: [isnotnull(event_date" in plan_of(views.recent_days(view, AS_OF))
        assert pruned == laid_out


def test_materialize_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        catalog.materialize(spark.range(1), "nothing", "incremental")


def test_build_models_by_layer(spark, base, tmp_path):
    raw = events(
        spark,
        [
            (1, 1, "purchase", at(DAY)),
            (1, 1, "click", at(DAY)),
            (None, 1, "click", at(DAY)),
            (2, 2, "click", None),
        ],
    )
    members = users(spark, [(1, "us"), (2, "JP")])
    for table, schema, df in (("raw_events", schemas.RAW_EVENTS, raw), ("users", schemas.USERS, members)):
        catalog.create_table(spark, f"{base}.{table}", schema, schemas.AUDIT_COLUMN[table])
        catalog.append(df, f"{base}.{table}")
    place = str(tmp_path / "layers")
    for _ in range(2):
        names = models.build_models(spark, base, f"{base}.raw_events", f"{base}.users", place)
        report = models.check_models(spark, base, names, place)
    assert names["stg_users"] == f"{base}_staging.stg_users"
    assert names["daily_summary"] == f"{base}_marts.daily_summary"
    frames = models.model_frames(raw, members)
    for model, name in names.items():
        assert rows(spark.table(name)) == rows(frames[model])
        assert spark.table(name).columns == frames[model].columns
    failed = {tuple(r)[:3]: r.failures for r in report.collect() if r.failures}
    assert failed == {
        ("stg_events", "event_id", "unique"): 1,
        ("stg_events", "event_date", "not_null"): 1,
        ("daily_summary", "event_date", "not_null"): 1,
    }
    assert report.count() == 9
    kept = {t.tableName for t in spark.sql(f"SHOW TABLES IN {base}_checks").collect() if not t.isTemporary}
    assert kept == {
        "report",
        "unique_stg_events_event_id",
        "not_null_stg_events_event_date",
        "not_null_daily_summary_event_date",
    }
    assert rows(spark.table(f"{base}_checks.unique_stg_events_event_id")) == [(1, 2)]
    for name in ("staging", "marts", "checks"):
        spark.sql(f"DROP DATABASE {base}_{name} CASCADE")


def test_event_layout_prunes_days_and_splits_a_hot_one(spark, tmp_path):
    path = str(tmp_path / "events")
    # One user's single day holds nine tenths of all events.
    hot = spark.range(9_000).select(
        F.col("id").alias("event_id"),
        F.lit(7).cast("bigint").alias("user_id"),
        F.lit(at(DAY)).cast("timestamp_ntz").alias("event_timestamp"),
    )
    rest = spark.range(1_000).select(
        (F.col("id") + 9_000).alias("event_id"),
        (F.col("id") % 50).alias("user_id"),
        F.lit(at("2024-01-11")).cast("timestamp_ntz").alias("event_timestamp"),
    )
    layout.write_events(hot.unionByName(rest), path, partitions=8)
    assert len(list((tmp_path / "events" / "event_date=2024-01-10").glob("*.parquet"))) > 4
    for file in (tmp_path / "events" / "event_date=2024-01-11").glob("*.parquet"):
        ids = [r.user_id for r in spark.read.parquet(str(file)).collect()]
        assert ids == sorted(ids)
    read = layout.read_events(spark, path)
    assert read.count() == 10_000
    assert dict(read.dtypes)["event_date"] == "date"
    recent = reports.recent_daily_events(read, dt.date(2024, 1, 12), days=1)
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(recent)
    assert rows(recent) == [(dt.date(2024, 1, 11), 1_000, 50)]


def test_reports_prune_the_days_of_the_layout(spark, tmp_path):
    path = str(tmp_path / "events")
    raw = raw_events(spark, SF_DIR)
    layout.write_events(raw, path)
    laid_out = layout.read_events(spark, path, raw.schema)
    members = driver_users(spark, SF_DIR)
    for report in (
        lambda e: reports.recent_daily_events(e, AS_OF),
        lambda e: reports.conversion_tiers(e, members, AS_OF, days=14),
        lambda e: views.recent_days(views.daily_events(e), AS_OF),
        lambda e: views.country_purchase_rate(views.country_daily_summary(e, members), AS_OF),
    ):
        assert "PartitionFilters: [isnotnull(event_date" in plan_of(report(laid_out))
        assert rows(report(laid_out)) == rows(report(raw))
    assert rows(models.stg_events(laid_out)) == rows(models.stg_events(raw))


def test_models_prune_the_days_of_a_laid_out_table(spark, base, tmp_path):
    raw = raw_events(spark, SF_DIR)
    layout.save_events(raw, f"{base}.raw_events")
    members = driver_users(spark, SF_DIR)
    catalog.create_table(spark, f"{base}.users", schemas.USERS)
    catalog.append(members, f"{base}.users")
    place = str(tmp_path / "layers")
    names = models.build_models(spark, base, f"{base}.raw_events", f"{base}.users", place)
    recent = spark.table(names["stg_events"]).filter(F.col("event_date") >= AS_OF)
    plan = plan_of(recent)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert rows(recent) == rows(models.stg_events(raw).filter(F.col("event_date") >= AS_OF))
    mart = models.model_frames(raw, members)["daily_summary"]
    assert rows(spark.table(names["daily_summary"])) == rows(mart)
    for name in ("staging", "marts"):
        spark.sql(f"DROP DATABASE {base}_{name} CASCADE")


def test_reports_look_back_from_today_by_default(spark):
    today = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    old = today - dt.timedelta(days=40)
    frame = events(spark, [(1, 1, "click", today), (2, 1, "click", old)])
    assert [r.event_count for r in reports.recent_daily_events(frame).collect()] == [1]
    tiers = reports.conversion_tiers(frame, users(spark, [(1, "US")]))
    assert [r.event_count for r in tiers.collect()] == [1]


def test_scratch_lies_in_the_named_checkpoint_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoints(spark) == shared
    path = scratch_path(spark, "x")
    assert path.startswith(shared) and path != scratch_path(spark, "x")


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    class Session:
        def __init__(self, master, folder=None):
            self.conf = self.sparkContext = self
            self.master, self.folder = master, folder

        def get(self, key, default):
            return default

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    with pytest.raises(RuntimeError):
        ensure_checkpoints(Session("yarn"))
    assert ensure_checkpoints(Session("yarn", "hdfs://shared")) == "hdfs://shared"
    assert "hitledger-" in ensure_checkpoints(Session("local[2]"))
