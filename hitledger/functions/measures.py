"""Rates and tiers shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest purchase rate of each tier, bounds included.
HIGH_RATE = 0.05
MEDIUM_RATE = 0.02


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """`part / whole`, rounded half up. `whole` is a group's count, never 0."""
    return F.round(part.cast("double") / whole, digits)


def conversion_tier(rate: Column) -> Column:
    return (
        F.when(rate >= HIGH_RATE, "High")
        .when(rate >= MEDIUM_RATE, "Medium")
        .otherwise("Low")
    )
