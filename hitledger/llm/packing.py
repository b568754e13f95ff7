"""Best-fit packing of token sequences, repacked where a lower bound shows a gap.

Documents become pieces of at most `capacity` tokens; only one longer than that is cut.
The pieces, without their tokens, are dealt out at random into partitions of bounded
size, and each is packed best fit in decreasing length. Dual feasible functions give a
lower bound of the number of bins that any packing of the partition needs; a partition
that meets it is certified. What remains is packed again: partitions with a gap, and
the bins that rounding to whole partitions leaves emptier than need be, give up their
emptiest bins, the pieces of which are exchanged and repacked together, round by round,
until they fit one partition or a round saves no bin. A round that needs more bins than
it was given is undone. Every partition of every round carries its bound into the
result; `certificates` and `overall_certificate` report bins against bounds.

A missing text is an empty document: its piece is the end id. Rows that repeat an id
are documents of their own. An empty table gives no piece, no partition, and no bin
against a bound of none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import give_back, saved, text_bytes
from hitledger.llm.tokens import PIECES, encoder

CAPACITY = 2048
# Pieces that one task packs at a time.
PARTITION_PIECES = 50_000
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame,
    tokenizer: str,
    borders: str | None = None,
    end_id: int = 0,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = PIECES,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, and the checksum of its ids.

    `remembered` bounds the words that a Python worker keeps the ids of.
    """
    plain = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, borders, remembered)
        end = np.array([end_id], encode.dtype).tobytes()
        for batch in batches:
            rows = []
            ids = batch.column("id").to_pylist()
            for doc, text in zip(ids, text_bytes(batch.column("text")), strict=True):
                tokens = np.frombuffer(encode.encode(text) + end, encode.dtype)
                for i, at in enumerate(range(0, len(tokens), capacity)):
                    own = tokens[at : at + capacity]
                    rows.append((doc, i, at, len(own), zlib.crc32(own.astype("<u4").tobytes())))
            yield _batch(list(zip(*rows, strict=True)) or [[]] * 5)
        give_back()

    return plain.mapInArrow(cut, _PIECE)


def _batch(columns: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in _PIECE.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing of these lengths needs."""
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1), capacity)


def bound_of_counts(counts: np.ndarray, capacity: int) -> int:
    """The bound, from how many pieces have each length from 0 to the capacity.

    It is the best of two families of dual feasible functions. For a threshold t,
    lengths over capacity - t count as a whole bin, those below t as nothing, all others
    as they are; t = 0 is the bound by volume. For a number k, a length counts as many
    k-ths of a bin as it has whole (k + 1)-ths, or as it is if it has nothing beyond them.
    """
    counts = counts.astype(np.int64)
    volume = counts * np.arange(capacity + 1)
    below, number = np.cumsum(volume), np.cumsum(counts)
    t = np.arange(capacity // 2 + 1)
    whole = number[-1] - number[capacity - t]
    middle = below[capacity - t] - np.where(t > 0, below[np.maximum(t - 1, 0)], 0)
    best = int((whole + -(-middle // capacity)).max())
    length = np.arange(capacity + 1)
    for k in range(1, 21):
        parts, beyond = np.divmod((k + 1) * length, capacity)
        size = np.where(beyond == 0, k * length, parts * capacity)
        best = max(best, -(-int((counts * size).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each length, and what each bin has left.

    `free` has a bit for each room that some open bin has; the tightest fitting bin is
    the lowest bit at or above the length.
    """
    bins = np.empty(len(lengths), np.int64)
    left: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = free >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                free ^= 1 << room
        else:
            b, room = len(left), capacity
            left.append(capacity)
        bins[i] = b
        left[b] = room = room - length
        if room:
            by_room[room].append(b)
            free |= 1 << room
    return bins, np.array(left, np.int64)


def _given_up(left: np.ndarray, bound: int, capacity: int) -> np.ndarray:
    """Which bins go into the next round: the emptiest, with room for what is too much.

    With a gap of g bins, bins with room for 2 g + 1 are given up; without one, only the
    emptiest, as other partitions' emptiest may fit with it.
    """
    order = np.argsort(-left, kind="stable")
    wanted = capacity * (2 * (len(left) - bound) + 1)
    room = np.cumsum(left[order])
    n = min(len(left), int(np.searchsorted(room, wanted)) + 1)
    chosen = np.zeros(len(left), bool)
    chosen[order[:n]] = True
    return chosen & (left > 0)


def packed(rows: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset; a sequence's offsets have no gaps.

    `partition_bins` and `partition_bound` are the bins, and the bound, of the partition
    that placed the piece for good, with those of its bins that it gave up afterwards.
    """
    pool = saved(rows.withColumn("_row", F.monotonically_increasing_id()), "packing-pieces")
    done = before = given = None
    number = 0
    while True:
        n = max(1, -(-pool.count() // partition_pieces))
        bucket = F.pmod(F.xxhash64("_row", F.lit(number)), F.lit(n))
        result = saved(
            pool.withColumn("_bucket", bucket)
            .groupBy("_bucket")
            .applyInArrow(
                _packer(capacity, n == 1, number),
                f"{_PIECE}, _row long, sequence_id long, offset long, "
                "partition_bins long, partition_bound long, _again boolean",
            ),
            "packing-round",
        )
        # Each bin has one piece at its beginning.
        bins, again = (
            result.where("offset = 0").agg(F.count("*"), F.coalesce(F.count_if("_again"), F.lit(0))).first()
        )
        if given is not None and bins > given:
            return done.unionByName(before)
        kept = result.where("not _again").drop("_again", "_row")
        done = kept if done is None else done.unionByName(kept)
        if not again:
            return done
        before = result.where("_again").drop("_again", "_row")
        # Without a saving, rounds go on only while they soon come down to one partition.
        if given is not None and bins == given and 2 * again > given:
            return done.unionByName(before)
        given = again
        pool = result.where("_again").select(*pool.columns)
        number += 1


def certificates(found: DataFrame) -> DataFrame:
    """Per partition that placed pieces for good: partition, bins, bound, kept_bins, certified.

    `bins` against `bound` is what its best fit reached; `kept_bins` of them it did not
    give up, or took back. A certified partition cannot be packed into fewer bins.
    """
    return (
        found.groupBy(F.shiftright("sequence_id", _BIN_BITS).alias("partition"))
        .agg(
            F.max("partition_bins").alias("bins"),
            F.max("partition_bound").alias("bound"),
            F.count_if(F.col("offset") == 0).alias("kept_bins"),
        )
        .withColumn("certified", F.col("bins") == F.col("bound"))
    )


def overall_certificate(found: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """All sequences, and the bound of any packing of all pieces together.

    Only the histogram of lengths, one row for each up to the capacity, comes to the driver.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in found.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return found.where("offset = 0").count(), bound_of_counts(counts, capacity)


# A sequence's number: round, partition of the round, bin of the partition. A partition has
# far fewer than 2^24 pieces; 2^28 partitions hold 10^13.
_BIN_BITS, _PARTITION_BITS = 24, 28


def _packer(capacity: int, alone: bool, number: int):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, left = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        # A lone partition has none to exchange with.
        again = np.zeros(len(left), bool) if alone else _given_up(left, bound, capacity)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        first = np.concatenate(([True], np.diff(bins[order]) > 0))
        base = np.repeat(begins[first], np.diff(np.append(np.flatnonzero(first), len(order))))
        offset = np.empty(len(order), np.int64)
        offset[order] = begins - base
        partition = (number << _PARTITION_BITS) + int(key[0].as_py())
        sequence = (partition << _BIN_BITS) + bins
        return (
            table.drop_columns(["_bucket"])
            .append_column("sequence_id", pa.array(sequence, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
            .append_column("partition_bins", pa.array(np.full(len(order), len(left)), pa.int64()))
            .append_column("partition_bound", pa.array(np.full(len(order), bound), pa.int64()))
            .append_column("_again", pa.array(again[bins]))
        )

    return pack
