"""Whitening against exact sums and numpy on all rows at once."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from helpers import clashing, rows

from hitledger.llm import queries, whitening

INF = float("inf")
SCHEMA = "vec_id long, embedding array<float>"


def plain(data):
    """(id, x) of the rows that stay, their n and S, and each row's exact deviation."""
    good = [
        (i, [math.floor(float(np.float32(c)) * 1024) + 100_000 for c in v])
        for i, v in data
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    n = len(good)
    sums = [sum(x) for x in zip(*[x for _, x in good], strict=True)]
    return good, n, sums, [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for _, x in good]


def compare(spark, data, found, components=8):
    good, n, sums, deviations = plain(data)
    result = found.collect()
    assert sorted((r.vec_id, r.whitening.n, int(r.whitening.deviation)) for r in result) == sorted(
        (i, n, d) for (i, _), d in zip(good, deviations, strict=True)
    )
    x = np.array([v for _, v in good], float) - [float(Fraction(s, n)) for s in sums]
    v = x.T @ x / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    mine = {r.vec_id: np.array(r.whitening.whitened) for r in result}
    got = np.array([mine[i] for i, _ in good])
    want = x @ axes / np.sqrt(values)
    signs = np.sign((got * want).sum(axis=0))
    assert np.allclose(got * signs, want, atol=1e-7)
    first = result[0].whitening
    assert np.allclose(first.explained, values / np.trace(v), rtol=1e-9)
    assert all(r.whitening.explained == first.explained for r in result)
    cov = got.T @ got / n - np.outer(got.mean(0), got.mean(0))
    assert first.identity_error < 1e-6
    assert abs(first.identity_error - np.abs(cov - np.eye(len(cov))).max()) < 1e-9


def vectors(size=12, n=400, seed=1):
    draw = random.Random(seed)
    data = [(i, [draw.gauss(0, 0.1 + k / 10) for k in range(size)]) for i in range(n)]
    return data


def test_against_numpy_with_odd_and_repeated_rows(spark):
    data = vectors()
    data += [(1000 + i, data[7][1]) for i in range(300)] + [(7, data[9][1])] * 0
    odd = [(2000, None), (2001, []), (2002, [None] * 12), (2003, [INF] + [0.0] * 11), (2004, [float("nan")] * 12)]
    df = spark.createDataFrame(data + odd, SCHEMA).repartition(5)
    compare(spark, data + odd, whitening.whitened(df))


def test_fewer_dimensions_than_components(spark):
    data = vectors(size=3, n=50)
    compare(spark, data, whitening.whitened(spark.createDataFrame(data, SCHEMA)))


def test_exact_beyond_64_bits(spark):
    data = [(i, [float(2**40) * (i % 7) + 1, -float(2**41) * (i % 5)]) for i in range(60)]
    found = whitening.whitened(spark.createDataFrame(data, SCHEMA)).collect()
    _, _, _, deviations = plain(data)
    assert sorted(int(r.whitening.deviation) for r in found) == sorted(deviations)
    assert max(deviations) > 2**63


def test_weights_of_one(spark):
    data = vectors(n=60)
    repeated = data + [(100 + i, data[3][1]) for i in range(500)]
    once = whitening.whitened(spark.createDataFrame(data, SCHEMA))
    ones = whitening.whitened(spark.createDataFrame(repeated, SCHEMA), weights="ones")
    assert ones.count() == 560
    a = {r.vec_id: r.whitening for r in once.collect()}
    for r in ones.where("vec_id < 60").collect():
        assert r.whitening.n == 60 and r.whitening.deviation == a[r.vec_id].deviation
        assert np.allclose(np.abs(r.whitening.whitened), np.abs(a[r.vec_id].whitened), atol=1e-6)
    with pytest.raises(ValueError):
        whitening.whitened(once, weights="none")


def test_rows_that_do_not_vary_or_have_other_dimensions(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], SCHEMA)
    assert whitening.whitened(one).count() == 0
    data = [(i, [float(i), 1.0, float(i * i)]) for i in range(9)] + [(50, [1.0]), (51, [2.0, 3.0])]
    found = whitening.whitened(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r.vec_id for r in found} == set(range(9))
    assert {len(r.whitening.whitened) for r in found} == {2}


def test_empty_table_and_clashing_names(spark):
    data = vectors(n=30)
    df = clashing(spark.createDataFrame(data, SCHEMA).withColumnRenamed("vec_id", "doc_id"))
    df = df.withColumnsRenamed({"doc_id": "x", "_sha": "row", "_row": "weight", "_doc": "whitening"})
    found = whitening.whitened(df)
    assert found.columns == [*df.columns, "_whitening"]
    assert rows(found.select("x", "row", "weight", "whitening")) == rows(df.select("x", "row", "weight", "whitening"))
    assert whitening.whitened(df.where("false")).collect() == []


def test_query(spark):
    found = queries.op13_whitening(spark, "/root/testdata/sf0.001")
    assert found.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]
    vecs = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert found.count() == 8 * vecs and found.where("identity_error > 0.0001").count() == 0
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"
