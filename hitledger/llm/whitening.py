"""Embedding whitening by the covariance of distinct vectors, weighted by how often they occur.

Entries are first made whole numbers (`LEVELS` to one, lifted by `OFFSET`), so that equal
vectors are equal exactly. Equal vectors are counted once, before anything else; the mean and the
covariance come from the distinct ones with their counts (or 1) as weights: partial sums and
centred matrix products per task, added up by Spark. The driver sees one matrix of the
dimensions, takes its eigenvectors, and each distinct vector is projected once. A join by a
128-bit key of the vector brings the result back to the rows, of which a hot vector may have any
share: the join starts from two shuffles, which adaptive execution can split.

Defined results:

- a vector that is missing, or holds a missing or non-finite entry or one of 2^52 and more, is
  left out of everything; so is one whose number of dimensions is not that of most vectors (of
  the larger number if two are as frequent), and a vector without entries,
- repeated rows weigh as often as they come (`weights="counts"`) or once (`"ones"`), and are all
  returned,
- components whose variance is nothing but rounding (a constant dimension, a single vector) do
  not exist; with none left, or an empty table, the result is empty,
- equal eigenvalues leave the choice of their components open; it is the same for all rows,
- columns of the input stay as they are, whatever their names.

The matrix is dimensions squared: 64 dimensions are 32 kB, 4096 are 134 MB in the driver, which is
the bound of the method.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import ready, saved, with_free_name

LEVELS, OFFSET = 1024, 100_000
COMPONENTS = 8
# Entries from here on cannot be told apart by whole numbers.
TOO_LARGE = float(2**52)
_EXACT = 2**62


@dataclass(frozen=True)
class Whitener:
    """n vectors with sums per dimension; variances and unit components, largest first."""

    n: int
    sums: list[int]
    variances: np.ndarray
    components: np.ndarray
    total: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.total) for v in self.variances]


def levels(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Columns row, x (whole numbers) and its key, for the vectors that are not left out."""
    slim = vectors.select(F.struct(*vectors.columns).alias("row"), F.col(vector).alias("v"))
    whole = F.forall("v", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < TOO_LARGE))
    x = F.transform("v", lambda c: F.floor(c.cast("double") * LEVELS) + OFFSET)
    found = slim.where(F.col("v").isNotNull() & (F.size("v") > 0) & whole).select("row", x.alias("x"))
    return found.withColumns(
        {"key_a": F.xxhash64("x"), "key_b": F.xxhash64(F.lit("other key"), "x")}
    )


def distinct_vectors(found: DataFrame, weights: str = "counts") -> DataFrame:
    """Every vector of the common number of dimensions once, with its weight, written down."""
    if weights not in ("counts", "ones"):
        raise ValueError(f"unknown weights: {weights}")
    counted = found.groupBy("x", "key_a", "key_b").agg(F.count("*").alias("rows"))
    counted = saved(counted, "distinct-vectors")
    sizes = counted.groupBy(F.size("x").alias("size")).agg(F.sum("rows").alias("rows"))
    common = sizes.orderBy(F.desc("rows"), F.desc("size")).limit(1).collect()
    size = common[0]["size"] if common else 0
    weight = F.col("rows") if weights == "counts" else F.lit(1).cast("long")
    return counted.where(F.size("x") == size).withColumn("weight", weight)


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a batch as rows of a matrix, and their weights."""
    x, w = batch.column("x"), batch.column("weight")
    return x.flatten().to_numpy().reshape(len(x), -1), w.to_numpy()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums per dimension, and at place -1 the sum of the weights."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            x, w = _arrays(batch)
            if int(np.abs(x).max()) * int(w.sum()) >= _EXACT:
                x, w = x.astype(object), w.astype(object)
            part = (x * w[:, None]).sum(axis=0).astype(object)
            n, total = n + int(w.sum()), part if total is None else total + part
    if total is not None:
        parts = [Decimal(n), *map(Decimal, total.tolist())]
        places = pa.array(range(-1, len(parts) - 1), pa.int32())
        yield pa.record_batch([places, pa.array(parts, pa.decimal128(38, 0))], ["place", "part"])


def _products(mean: np.ndarray):
    """Sums of weighted products of centred dimensions, one row for each pair i <= j."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        some = False
        for batch in batches:
            if batch.num_rows:
                x, w = _arrays(batch)
                centred = x - mean
                total += (centred * w[:, None]).T @ centred
                some = True
        if some:
            i, j = np.triu_indices(len(mean))
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])]
            yield pa.record_batch(columns, ["i", "j", "part"])

    return partial


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of weighted distinct vectors; None where nothing varies."""
    slim = distinct.select("x", "weight")
    sums = slim.mapInArrow(_sums, "place int, part decimal(38,0)")
    added = {r.place: int(r.part) for r in sums.groupBy("place").agg(F.sum("part").alias("part")).collect()}
    if not added:
        return None
    n, size = added.pop(-1), len(added)
    totals = [added[i] for i in range(size)]
    mean = np.array([s / n for s in totals])
    products = slim.mapInArrow(_products(mean), "i int, j int, part double")
    v = np.zeros((size, size))
    for r in products.groupBy("i", "j").agg(F.sum("part").alias("part")).toLocalIterator():
        v[r.i, r.j] = v[r.j, r.i] = r.part / n
    variances, axes = np.linalg.eigh(v)
    variances, axes = variances[::-1][:components], axes[:, ::-1][:, :components]
    real = variances > max(variances[0], 0) * size * np.finfo(float).eps
    if not real.any():
        return None
    return Whitener(n, totals, variances[real], axes[:, real], float(np.trace(v)))


def _projected(model: Whitener):
    n, sums = model.n, model.sums
    mean = np.array([s / n for s in sums])
    axes = model.components / np.sqrt(model.variances)

    def deviations(x: np.ndarray) -> list[int]:
        """Sums over dimensions of (n x - S)^2, without rounding."""
        most = n * int(np.abs(x).max()) + max(map(abs, sums))
        if most < 2**52 and most * most * len(sums) < _EXACT:
            return ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
        return ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1).tolist()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, _ = _arrays(batch)
                white = (x - mean) @ axes
                yield pa.record_batch(
                    [
                        batch.column("key_a"),
                        batch.column("key_b"),
                        batch.column("weight"),
                        pa.array(map(str, deviations(x)), pa.string()),
                        pa.FixedSizeListArray.from_arrays(white.ravel(), white.shape[1]).cast(
                            pa.list_(pa.float64())
                        ),
                    ],
                    ["key_a", "key_b", "weight", "deviation", "whitened"],
                )

    return project


def identity_error(white: DataFrame, size: int) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    n = F.sum("weight")
    y, w = [F.col("whitened")[i] for i in range(size)], F.col("weight")
    means = white.agg(*[(F.sum(w * c) / n).alias(f"m{i}") for i, c in enumerate(y)]).first()
    centred = [c - F.lit(m) for c, m in zip(y, means, strict=True)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = white.agg(*[(F.sum(w * centred[i] * centred[j]) / n).alias(f"c{i}_{j}") for i, j in pairs])
    return max(abs(v - (i == j)) for v, (i, j) in zip(found.first(), pairs, strict=True))


def whitened(
    vectors: DataFrame,
    vector: str = "embedding",
    components: int = COMPONENTS,
    weights: str = "counts",
) -> DataFrame:
    """The rows that are not left out, and a struct `whitening` (or the next free name).

    It holds n, the deviation as text (an exact whole number of any length), the whitened
    vector, the share of the variance that each of its components explains, and the identity
    error, which is one value for all.
    """
    spark = ready(vectors.sparkSession)
    found = levels(vectors, vector)
    distinct = distinct_vectors(found, weights)
    model = fit(distinct, components)
    name = with_free_name(vectors, "whitening")
    fields = (
        "struct<n:bigint,deviation:string,whitened:array<double>,"
        "explained:array<double>,identity_error:double>"
    )
    if model is None:
        return spark.createDataFrame([], vectors.schema).withColumn(name, F.lit(None).cast(fields))
    schema = "key_a long, key_b long, weight long, deviation string, whitened array<double>"
    slim = distinct.select("key_a", "key_b", "x", "weight")
    white = saved(slim.mapInArrow(_projected(model), schema), "whitened-vectors")
    error = identity_error(white, len(model.variances))
    whitening = F.struct(
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(e) for e in model.explained]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
    rows = found.select("key_a", "key_b", "row")
    return rows.join(white, ["key_a", "key_b"]).select("row.*", whitening.alias(name))
