"""Data-quality checks: each names the rows that fail, or counts them."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Check(NamedTuple):
    """A declared check of one model column: `not_null` or `unique`."""

    model: str
    column: str
    name: str


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value in the column."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is not in the list; NULL is left to `not_null`."""
    return df.filter(~F.col(column).isin(values))


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows whose value lies outside the bounds, which are legal themselves."""
    value = F.col(column)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    return df.filter(outside)


def null_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return not_null(df, column).agg(F.count("*").alias(name))


def negative_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return accepted_range(df, column, low=0).agg(F.count("*").alias(name))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """What a declared check objects to: rows, or repeated values."""
    return {"not_null": not_null, "unique": unique}[check.name](df, check.column)


def run_checks(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Failures of every check, one row each.

    All NULL checks of a model share one scan that ends in a single row per
    task; a uniqueness check shuffles its key column only.
    """
    reports = []
    for model, df in models.items():
        mine = [c for c in checks if c.model == model]
        required = [c.column for c in mine if c.name == "not_null"]
        if required:
            counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
            nulls = counts.unpivot([], required, "column_name", "failures")
            reports.append(_report(nulls, model, "not_null"))
        for column in [c.column for c in mine if c.name == "unique"]:
            repeats = unique(df, column).agg(F.count("*").alias("failures"))
            reports.append(_report(repeats.withColumn("column_name", F.lit(column)), model, "unique"))
    return reduce(DataFrame.unionByName, reports)


def _report(failures: DataFrame, model: str, check: str) -> DataFrame:
    return failures.select(
        F.lit(model).alias("model"), "column_name", F.lit(check).alias("check_name"), "failures"
    )
