"""Calendar expressions over zone-less event times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_event_date(events: DataFrame) -> DataFrame:
    """Give every event its calendar day.

    A table laid out by `event_date` already carries the column; it is kept as
    it is, so that a filter on it prunes directories instead of reading them.
    Otherwise it is derived, and Catalyst turns a date filter on it back into
    a timestamp range for the Parquet scan.
    """
    if "event_date" in events.columns:
        return events
    return events.withColumn("event_date", F.to_date("event_timestamp"))


def event_date_sql(columns: list[str]) -> str:
    """The same choice for the SQL text of a view over a table of these columns."""
    return "event_date" if "event_date" in columns else "to_date(event_timestamp)"


def days_before(as_of: dt.date | None, days: int) -> Column:
    """The date `days` before `as_of`, or before today where none is given."""
    anchor = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(anchor, days)


def week_start(day: Column) -> Column:
    """Monday of the day's week, as a date."""
    return F.trunc(day, "WEEK")


def week_end(day: Column) -> Column:
    """Sunday of the day's week, as a date."""
    return F.date_add(week_start(day), 6)
