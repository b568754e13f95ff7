"""Exact summaries of any numeric column, by selection in ranges."""

import random
import statistics

import pytest

from hitledger.operators import profiling


def plain(values):
    values = sorted(v for v in values if v is not None and v == v)
    n = len(values)
    if not n:
        return (0, None, None, None, None, None, None, None)
    quartiles = []
    for q in (0.25, 0.5, 0.75):
        h = (n - 1) * q
        low, high = values[int(h)], values[min(int(h) + 1, n - 1)]
        quartiles.append(low + (high - low) * (h - int(h)))
    std = statistics.stdev(values) if n > 1 else None
    return (n, statistics.fmean(values), std, values[0], *quartiles, values[-1])


def check(spark, values, kind, partitions=5):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(partitions)
    found, expected = tuple(profiling.describe(df, "v").first()), plain(values)
    assert found[0] == expected[0]
    for x, y in zip(found[1:], expected[1:], strict=True):
        assert x == pytest.approx(y, rel=1e-12) if y is not None else x is None


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 999])
def test_distinct_doubles(spark, n):
    draw = random.Random(n)
    check(spark, [draw.gauss(1e6, 1) for _ in range(n)] + [None, float("nan")], "double")


def test_wide_and_repeated_whole_numbers(spark):
    draw = random.Random(2)
    check(spark, [draw.randrange(-(2**50), 2**50) for _ in range(2000)], "long")
    check(spark, [draw.choice([1, 1, 1, 2, 50]) for _ in range(700)] + [None] * 9, "int")
    check(spark, [7] * 300, "long")


def test_nothing_to_describe(spark):
    check(spark, [], "long", 1)
    check(spark, [None, None], "double", 1)


def test_only_the_ranges_of_the_ranks_are_ordered(spark, monkeypatch):
    """100,000 distinct values in 20 ranges: what is ordered is three of them, or four."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "20"}
    old = {k: spark.conf.get(k) for k in settings}
    ranges = []
    select = profiling._at_ranks

    def seen(histogram):
        ranges.extend(r["count"] for r in histogram.groupBy("part").count().collect())
        return select(histogram)

    monkeypatch.setattr(profiling, "_at_ranks", seen)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(100_000).selectExpr("id * 7 % 100000 + 0.5D AS v")
        found = profiling.describe(df, "v").first()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert (found.p25, found.p50, found.p75) == (25_000.25, 50_000.0, 74_999.75)
    assert len(ranges) == 20 and max(ranges) < 10_000
