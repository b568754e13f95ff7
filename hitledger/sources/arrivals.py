"""Events as they arrive: one load after the other, laid out by load and day.

A load holds the events of one delivery, of whatever days. Directories by load, then day, tell
from the catalog alone, without opening a file, which days a load has touched; and all events of
some days are read by pruning, whichever load brought them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.functions.calendar import with_event_date
from hitledger.sources.catalog import quoted


def create_arrivals(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """An empty table of events in place of any of that name."""
    columns = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
    columns += ["load_id BIGINT", "event_date DATE"]
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet "
        "PARTITIONED BY (load_id, event_date)"
    )


def append_load(events: DataFrame, table: str, load_id: int) -> None:
    """Add one load. Its id must be greater than those of all loads before it.

    A load that fails while it is written leaves no partition behind and can be repeated. Events
    without a time form a day of their own. The days are dealt out by size, so a busy day is
    written by many tasks and a quiet one ends in one file.
    """
    spark = events.sparkSession
    newest = max((load for load, _ in partitions(spark, table)), default=None)
    if newest is not None and load_id <= newest:
        raise ValueError(f"{table} has load {newest}; {load_id} is not after it")
    rows = with_event_date(events).withColumn("load_id", F.lit(load_id).cast("long"))
    columns = spark.table(table).columns
    rows.select(*columns).hint("rebalance", "event_date").write.insertInto(table)


def partitions(spark: SparkSession, table: str) -> list[tuple[int, dt.date | None]]:
    """(load, day) of every partition, from the catalog."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator():
        load, day = (part.partition("=")[2] for part in row[0].split("/"))
        found.append((int(load), None if day.startswith("__") else dt.date.fromisoformat(day)))
    return found


def touched_days(spark: SparkSession, table: str, after: int | None) -> set[dt.date | None]:
    """Days that loads after the given one brought events for; None stands for no day."""
    return {day for load, day in partitions(spark, table) if after is None or load > after}


def events_of(spark: SparkSession, table: str, days: set[dt.date | None]) -> DataFrame:
    """All events of some days; the others' files are not read."""
    return spark.table(table).where(is_among("event_date", days))


def is_among(column: str, values: set[dt.date | None]):
    """Is the date one of these? None stands for NULL."""
    known = sorted(v for v in values if v is not None)
    found = F.coalesce(F.col(column).isin(known), F.lit(False)) if None in values else F.col(column).isin(known)
    return found | F.col(column).isNull() if None in values else found
