"""Rewriting laid-out events and models: nothing is lost on the way."""

import uuid

import pytest
from frames import at, events, rows, users
from pyspark.sql import functions as F

from hitledger.sources import catalog, layout


@pytest.fixture
def base(spark):
    name = f"layout_{uuid.uuid4().hex}"
    catalog.create_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def some(spark, first, n=100):
    return events(spark, [(i, i % 7, "click", at(f"2024-01-0{1 + i % 5}")) for i in range(first, first + n)])


def failing(df):
    return df.withColumn("country", F.when(F.col("event_id") > 0, F.raise_error(F.lit("broken"))))


def tables_of(spark, base):
    return {r.tableName for r in spark.sql(f"SHOW TABLES IN {base}").collect() if r.namespace == base}


def test_a_failed_rewrite_keeps_the_table(spark, base):
    table = f"{base}.raw_events"
    layout.save_events(some(spark, 0), table)
    before = rows(spark.table(table))
    with pytest.raises(Exception, match="broken"):
        layout.save_events(failing(some(spark, 500)), table, partitions=3)
    assert rows(spark.table(table)) == before and len(before) == 100
    assert tables_of(spark, base) == {"raw_events"}


def test_a_table_is_laid_out_from_itself(spark, base):
    table = f"{base}.raw_events"
    layout.save_events(some(spark, 0), table)
    layout.save_events(spark.table(table).unionByName(spark.table(table).where("event_id < 10")), table)
    assert spark.table(table).count() == 110
    layout.save_events(spark.table(table).where("event_date = '2024-01-02'"), table)
    assert {str(r[0]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} == {"event_date=2024-01-02"}
    assert spark.table(table).where("event_date = '2024-01-01'").count() == 0
    assert tables_of(spark, base) == {"raw_events"}


def test_a_failed_renaming_is_taken_back(spark, base, monkeypatch):
    table = f"{base}.raw_events"
    layout.save_events(some(spark, 0), table)
    before = rows(spark.table(table))
    with pytest.raises(Exception):
        catalog.replace_entry(spark, table, f"{base}.not_there")
    assert rows(spark.table(table)) == before


def test_views_follow_the_new_layout(spark, base):
    table = f"{base}.raw_events"
    layout.save_events(some(spark, 0), table)
    catalog.create_view(spark, f"{base}.days", f"SELECT event_date, count(*) AS n FROM {table} GROUP BY ALL")
    layout.save_events(some(spark, 0, 35), table)
    assert spark.table(f"{base}.days").agg(F.sum("n")).first()[0] == 35


def test_files_change_places_when_complete(spark, tmp_path):
    path = str(tmp_path / "events")
    layout.write_events(some(spark, 0), path)
    with pytest.raises(Exception, match="broken"):
        layout.write_events(failing(some(spark, 500)), path, partitions=3)
    assert layout.read_events(spark, path).count() == 100
    layout.write_events(layout.read_events(spark, path).where("event_id < 40"), path)
    assert layout.read_events(spark, path).count() == 40
    with pytest.raises(OSError):
        catalog.swap_folder(spark, path, str(tmp_path / "nothing"))
    assert layout.read_events(spark, path).count() == 40


def test_a_model_of_another_schema_replaces_the_old_one(spark, base):
    name = f"{base}.model"
    people = users(spark, [(1, "US"), (2, "JP")])
    catalog.materialize(people, name, "table")
    catalog.materialize(spark.table(name).select("user_id", F.lit(1).alias("one")), name, "table")
    assert rows(spark.table(name)) == [(1, 1), (2, 1)]
    with pytest.raises(Exception, match="broken"):
        catalog.materialize(people.withColumn("x", F.raise_error(F.lit("broken"))), name, "table")
    assert rows(spark.table(name)) == [(1, 1), (2, 1)]
    assert tables_of(spark, base) == {"model"}
