"""A few whole rows of a large table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lowest_rows(table: DataFrame, key: str, limit: int) -> DataFrame:
    """The rows with the lowest keys, all columns, without reading all columns.

    The bound of the lowest keys is found by a scan of the key column alone. It
    then goes to the scan of the whole rows as a pushed filter, so that Parquet
    skips the row groups above it. Rows without a key come last.
    """
    value = F.col(key)
    lowest = table.select(key).orderBy(value.asc_nulls_last()).limit(limit)
    bound = lowest.agg(F.max(key)).scalar()
    wanted = table.filter((value <= bound) | value.isNull())
    return wanted.orderBy(value.asc_nulls_last()).limit(limit)
