"""Column profiles: value counts and numeric summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.sources.scratch import scratch_path


def value_counts(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Rows per value of each column, NULLs left out; columns read `table.column`.

    One scan serves all columns: rows are counted per combination of values,
    and only the combinations are unfolded into one row per column.
    """
    named = [F.col(c).cast("string").alias(f"{table}.{c}") for c in columns]
    combinations = df.select(*named).groupBy(*[f"`{table}.{c}`" for c in columns])
    return (
        combinations.agg(F.count("*").alias("rows"))
        .unpivot("rows", [f"`{table}.{c}`" for c in columns], "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.sum("rows").alias("n"))
    )


QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of a numeric column.

    The column is reduced to its histogram, which may have as many values as the column has rows.
    It is dealt out by ranges of values and written down; the rows per range, added up in order,
    tell which ranges hold the wanted ranks, and only these are read again and ordered, each by a
    task of its own. The driver sees a row per range and a row per rank. Quartiles interpolate
    linearly. Whole numbers are summed exactly; NULLs are left out, and so are NaNs, which have no
    place in an order of numbers. Without a value all but the count is NULL.
    """
    spark = df.sparkSession
    kind = df.schema[column].dataType
    whole = isinstance(kind, T.IntegralType)
    rows = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull())
    if not whole:
        rows = rows.where(~F.isnan("value"))
    path = scratch_path(spark, "histogram")
    (
        rows.groupBy("value")
        .agg(F.count("*").alias("rows"))
        .repartitionByRange("value")
        .withColumn("part", F.spark_partition_id())
        .write.parquet(path)
    )
    histogram = spark.read.parquet(path)
    n, found = _at_ranks(histogram)
    quartiles = []
    for q in QUARTILES:
        if n:
            below, beyond = divmod((n - 1) * q, 1)
            low = float(found[int(below)])
            high = float(found[int(below) + (beyond > 0)])
            quartiles.append(F.lit(low + (high - low) * beyond))
        else:
            quartiles.append(F.lit(None).cast("double"))
    return (_whole_moments if whole else _moments)(histogram).select(
        "count",
        "mean",
        "std",
        "min",
        *[value.alias(f"p{int(100 * q)}") for q, value in zip(QUARTILES, quartiles, strict=True)],
        "max",
    )


def _at_ranks(histogram: DataFrame) -> tuple[int, dict[int, object]]:
    """The number of rows, and the values at the ranks, from 0, that quartiles lie between."""
    ranges = histogram.groupBy("part").agg(F.sum("rows").alias("rows")).orderBy("part").collect()
    n = sum(r.rows for r in ranges)
    if not n:
        return 0, {}
    ranks = sorted({min(int((n - 1) * q) + more, n - 1) for q in QUARTILES for more in (0, 1)})
    before, base = 0, {}
    for r in ranges:
        if any(before <= rank < before + r.rows for rank in ranks):
            base[r.part] = before
        before += r.rows
    start = F.create_map(*[F.lit(x).cast("long") for pair in base.items() for x in pair])
    end = F.sum("rows").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        histogram.where(F.col("part").isin(list(base)))
        .withColumn("end", end + start[F.col("part").cast("long")])
        .where(F.exists(F.array(*map(F.lit, ranks)), lambda k: (k < F.col("end")) & (k >= F.col("end") - F.col("rows"))))
    )
    found = {}
    for r in placed.select("value", "rows", "end").collect():
        found |= {rank: r.value for rank in ranks if r.end - r.rows <= rank < r.end}
    return n, found


def _whole_moments(histogram: DataFrame) -> DataFrame:
    value = F.col("value").cast("decimal(38,0)")
    rows = F.col("rows").cast("decimal(38,0)")
    sums = histogram.agg(
        F.sum("rows").alias("count"),
        F.sum(value * rows).alias("total"),
        F.sum(value * value * rows).alias("squares"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    n = F.col("count").cast("decimal(38,0)")
    spread = (n * F.col("squares") - F.col("total") * F.col("total")).cast("double")
    pairs = F.col("count").cast("double") * (F.col("count") - 1)
    return sums.select(
        F.coalesce("count", F.lit(0)).alias("count"),
        (F.col("total").cast("double") / F.col("count")).alias("mean"),
        F.when(F.col("count") > 1, F.sqrt(spread / pairs)).alias("std"),
        "min",
        "max",
    )


def _moments(histogram: DataFrame) -> DataFrame:
    """Of fractions: the squares are taken around the mean, as differences of sums lose digits."""
    value = F.col("value").cast("double")
    mean = (F.sum(value * F.col("rows")) / F.sum("rows")).alias("mean")
    about = F.lit(histogram.agg(mean).first()["mean"]).cast("double")
    sums = histogram.agg(
        F.sum("rows").alias("count"),
        F.sum((value - about) * (value - about) * F.col("rows")).alias("squares"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return sums.select(
        F.coalesce("count", F.lit(0)).alias("count"),
        about.alias("mean"),
        F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std"),
        "min",
        "max",
    )
