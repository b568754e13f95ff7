"""Bad and repeated records are set aside with file, line and reason."""

from pyspark.sql import functions as F

from hitledger import schemas
from hitledger.sources import clean_load
from hitledger.sources.clean_load import load_clean, numbered_lines

HEADER = "user_id,signup_date,country,plan_type,is_active"
GOOD = "1,2024-01-01,US,free,true"


def load(spark, folder, files, key="user_id"):
    for name, lines in files.items():
        (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")
    accepted, rejected = load_clean(spark, str(folder), schemas.USERS, key)
    kept = sorted(r.user_id for r in accepted.collect())
    refused = {(r.file.rsplit("/", 1)[1], r.line_no): r.reason for r in rejected.collect()}
    assert accepted.count() + rejected.count() == sum(map(len, files.values()))
    return accepted, kept, refused


def test_reasons(spark, tmp_path):
    lines = [
        GOOD, "x,2024-01-01,US,free,true", "3,2024-13-01,US,free,true", "4,20240101,US,free,true",
        "5,2024-01-01,,free,true", "6,2024-01-01,USA,free,true", "7,2024-01-01,US,free",
        "8,2024-01-01,US,free,true,more", "9,2024-01-01,US,free,perhaps", "", '10,2024-01-01,"JP","a, ""b""",false',
    ]
    accepted, kept, refused = load(spark, tmp_path, {"a.csv": lines})
    assert kept == [1, 10]
    assert accepted.where("user_id = 10").first().plan_type == 'a, "b"'
    assert [d for _, d in accepted.dtypes] == [f.dataType.simpleString() for f in schemas.USERS]
    assert refused == {
        ("a.csv", 3): "user_id: not a bigint",
        ("a.csv", 4): "signup_date: not a date",
        ("a.csv", 5): "signup_date: not a date",
        ("a.csv", 6): "country: no value in a required column",
        ("a.csv", 7): "country: text longer than 2",
        ("a.csv", 8): "wrong number of fields",
        ("a.csv", 9): "wrong number of fields",
        ("a.csv", 10): "is_active: not a boolean",
        ("a.csv", 11): "wrong number of fields",
    }


def test_the_last_of_a_key_stays(spark, tmp_path):
    files = {
        "a.csv": [GOOD, "1,2024-01-02,JP,free,true", "2,2024-01-01,US,free,true"],
        "b.csv": ["1,2024-01-03,DE,free,true", "1,bad,DE,free,true"],
    }
    accepted, kept, refused = load(spark, tmp_path, files)
    assert kept == [1, 2] and accepted.where("user_id = 1").first().country == "DE"
    assert refused == {
        ("a.csv", 2): "user_id: repeated",
        ("a.csv", 3): "user_id: repeated",
        ("b.csv", 3): "signup_date: not a date",
    }
    _, kept, refused = load(spark, tmp_path, files, key=None)
    assert kept == [1, 1, 1, 2] and len(refused) == 1


def test_line_numbers_across_pieces_of_a_file(spark, tmp_path):
    for name, n in (("a.txt", 5000), ("b.txt", 3), ("c.txt", 800)):
        (tmp_path / name).write_text("".join(f"{i}\n" for i in range(1, n + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        found = numbered_lines(spark, str(tmp_path))
        assert found.where(F.col("line").cast("long") != F.col("line_no")).count() == 0
        assert found.count() == 5803
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_many_records_are_dealt_to_tasks_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clean_load, "TASK_ROWS", 100, raising=False)
    record = "{},2024-01-01,US,free,true"
    files = {
        "b.csv": [record.format(i) for i in range(1500)],
        "a.csv": [record.format(i) for i in range(500, 2000)],
        "c.csv": [record.format(7)] * 600,
    }
    accepted, kept, refused = load(spark, tmp_path, files)
    assert kept == list(range(2000))
    # b.csv comes after a.csv, and c.csv after both, whichever is longer.
    assert refused == {
        **{("a.csv", i - 498): "user_id: repeated" for i in range(500, 1500)},
        **{("c.csv", i): "user_id: repeated" for i in range(2, 601)},
        ("b.csv", 9): "user_id: repeated",
    }
    per_task = accepted.groupBy(F.spark_partition_id()).count()
    assert per_task.agg(F.max("count")).first()[0] < 300


def test_nothing_to_load(spark, tmp_path):
    accepted, kept, refused = load(spark, tmp_path, {"a.csv": []})
    assert kept == [] and refused == {} and accepted.columns == schemas.USERS.names
