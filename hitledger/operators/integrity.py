"""Referential checks between a child and a parent table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key has none.

    Both sides reach the join straight from their shuffle, the shape in which
    adaptive execution can split a key that holds a large part of the child.
    """
    return child.join(parent.select(key), key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Number of child rows whose key has no parent, as one row.

    The child is counted per key before the join. A hot key becomes one row in
    the map-side combine, and the join reuses the shuffle of the counting.
    """
    per_key = child.groupBy(key).agg(F.count("*").alias("rows"))
    return orphans(per_key, parent, key).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(name))
