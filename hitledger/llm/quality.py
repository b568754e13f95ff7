"""A quality classifier: gradient-boosted trees on histograms of document statistics.

Statistics of whole texts (lengths, shares of kinds of characters, repetition of words,
word pairs and lines) are cut into bins; trees are grown level by level on histograms
of gradients per bin, on a bounded sample of labelled documents. A tree is complete and
lies in arrays, so that a batch of documents walks down all of them with one numpy step
per level. An empty or missing text has a vector of zeros and a score like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import WordHashes, mixed, text_bytes

# Labelled documents that training takes, at most.
SAMPLE = 20_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.15
MIN_LEAF_WEIGHT = 3.0

STATISTICS = (
    "log_bytes log_words word_length longest_word letters capitals digits blanks full_stops "
    "symbols bars beyond_ascii byte_entropy distinct_words commonest_word repeated_next "
    "distinct_pairs log_lines distinct_lines words_per_line capital_starts symbol_ends"
).split()

_KIND = np.zeros(256, np.int64)
for _i, _own in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c",
     b".,;:?'\"()-", b"|", bytes(range(0x80, 0x100))), 1
):
    _KIND[list(_own)] = _i

_hashes = WordHashes()


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, in the order of STATISTICS."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=8) / size
    symbols, small, capitals, digits, blanks, stops, bars, beyond = kinds.tolist()
    share = counts[counts > 0] / size
    hashes = _hashes.of(words)
    _, repeats = np.unique(hashes, return_counts=True)
    pairs = len(np.unique(mixed(hashes[:-1]) + hashes[1:])) / (n - 1) if n > 1 else 1.0
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip()]
    firsts = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
    lasts = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    return [
        np.log1p(size),
        np.log1p(n),
        lengths.mean(),
        np.log1p(lengths.max()),
        small + capitals + beyond,
        capitals,
        digits,
        blanks,
        stops,
        symbols,
        bars,
        beyond,
        float(-(share * np.log2(share)).sum()),
        len(repeats) / n,
        repeats.max() / n,
        float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0,
        pairs,
        np.log1p(len(lines)),
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        float((_KIND[firsts] == 2).mean()),
        float((_KIND[lasts] == 0).mean()),
    ]


@dataclass
class Forest:
    """Complete trees in arrays: node i has the children 2 i + 1 and 2 i + 2.

    `features` and `cuts` have a row per tree and a column per inner node, `leaves` a
    column per leaf. A vector goes right where its bin is greater than the cut.
    """

    edges: list[np.ndarray]
    base: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def binned(self, x: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, x[:, i]) for i, e in enumerate(self.edges)]
        return np.stack(columns, axis=1).astype(np.int16)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        if not len(x):
            return np.empty(0)
        bins, rows = self.binned(x), np.arange(len(x))
        total = np.full(len(x), self.base)
        depth = (self.leaves.shape[1]).bit_length() - 1
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (bins[rows, features[node]] > cuts[node])
            total += leaves[node - (leaves.size - 1)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for the logistic loss; each row of x is a document."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS)[1:-1])) for i in range(width)]
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    inner, n_leaves = 2**DEPTH - 1, 2**DEPTH
    forest = Forest(
        edges, float(np.log(rate / (1 - rate))), np.zeros((TREES, inner), np.int64),
        np.full((TREES, inner), BINS, np.int64), np.zeros((TREES, n_leaves)),
    )
    bins = forest.binned(x).astype(np.int64)
    flat = bins + np.arange(width) * BINS
    margin = np.full(n, forest.base)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, weight = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, open_ = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (width * BINS) + flat).ravel()
            shape = (open_, width, BINS)
            size = open_ * width * BINS
            g = np.bincount(place, np.repeat(slope, width), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(place, np.repeat(weight, width), size).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
            gain[(h < MIN_LEAF_WEIGHT) | (all_h - h < MIN_LEAF_WEIGHT)] = 0
            best = gain.reshape(open_, -1).argmax(axis=1)
            found = gain.reshape(open_, -1).max(axis=1) > 1e-9
            own = slice(first, first + open_)
            forest.features[tree, own] = np.where(found, best // BINS, 0)
            forest.cuts[tree, own] = np.where(found, best % BINS, BINS)
            cut = bins[np.arange(n), forest.features[tree, node]] > forest.cuts[tree, node]
            node = 2 * node + 1 + cut
        leaf = node - inner
        g = np.bincount(leaf, slope, n_leaves)
        h = np.bincount(leaf, weight, n_leaves)
        forest.leaves[tree] = RATE * g / (h + 1)
        margin += forest.leaves[tree, leaf]
    return forest


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Forest:
    """Trees from `labels` (doc_id, label 0 or 1), at most `sample` of them by a hash of the id.

    A document labelled several times has the label that most of them give, 1 in a tie;
    rows without id or label teach nothing. The sampled ids, bounded by `sample`, are
    broadcast, and their statistics reach the driver. Without labels all scores are 0.5.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        (F.avg("label") >= 0.5).cast("double").alias("label")
    )
    span = 1 << 30
    chance = min(span, 1 + span * sample // max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < chance).limit(sample)
    picked = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(statistics(t), "<f8").tobytes() for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
                names=["doc_id", "label", "x"],
            )

    # Rows that repeat an id add nothing, and are bounded by the same limit.
    rows = (
        picked.mapInArrow(vectors, "doc_id long, label double, x binary")
        .dropDuplicates(["doc_id"])
        .limit(sample)
        .collect()
    )
    rows = sorted(rows, key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"], "<f8") for r in rows]).reshape(-1, len(STATISTICS))
    y = np.array([r["label"] for r in rows])
    if not len(y):
        x, y = np.zeros((1, len(STATISTICS))), np.array([0.5])
    return grow(x, y)


def scored(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id and the score, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in text_bytes(batch.column("text"))])
            scores = shared.value.scores(x.reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"]
            )

    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return plain.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
