"""Physical layout of the event table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from hitledger.functions.calendar import with_event_date
from hitledger.sources.catalog import beside, new_folder, remove_folder, replace_entry, swap_folder

# Some 128 to 256 MB of Parquet.
ROWS_PER_FILE = 5_000_000


def write_events(events: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write events in one directory per day, clustered by user within it.

    Range partitioning by day, user and event spreads a busy day, or a single
    user's busy day, over as many tasks as its rows need, while a quiet day
    stays in one file. The rows of a file are sorted by user, which makes its
    row-group statistics selective. Finding the ranges reads the input a first
    time, which a table that is read often pays back.

    `partitions` is the number of ranges and so, about, of files. Without it the
    events are counted, one range for ROWS_PER_FILE of them: adaptive execution
    merges ranges that turn out small but splits none.

    The files are written beside those of an earlier layout and change places with them when
    they are complete, so a failure keeps the old rows.
    """
    spark = events.sparkSession
    new = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    _by_day(events, partitions).parquet(new)
    swap_folder(spark, path.rstrip("/"), new)


def save_events(events: DataFrame, table: str, partitions: int | None = None) -> None:
    """The same as a catalog table; models built on it prune days as well.

    The new rows are written as a table of their own, which takes over the name once it is
    complete. So a failure keeps the old rows, and a table may be laid out from itself.
    """
    spark = events.sparkSession
    new = beside(table)
    folder = new_folder(spark, table)
    try:
        _by_day(events, partitions).option("path", folder).saveAsTable(new, format="parquet")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        remove_folder(spark, folder)
        raise
    replace_entry(spark, table, new)


def read_events(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Events with their `event_date`; filters on it skip whole directories."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("event_date", T.DateType())]))
    return reader.parquet(path)


def _by_day(events: DataFrame, partitions: int | None) -> DataFrameWriter:
    keys = ["event_date", "user_id", "event_id"]
    if partitions is None:
        partitions = max(1, -(-events.count() // ROWS_PER_FILE))
    clustered = with_event_date(events).repartitionByRange(partitions, *keys)
    ordered = clustered.sortWithinPartitions("event_date", "user_id")
    return ordered.write.mode("overwrite").partitionBy("event_date")
