"""Language-model scores of documents by a weighted backoff automaton.

Words are counted over all documents, n-grams over the training ones. An n-gram seen at
least LEAST_COUNT times, whatever the size of the corpus, has an arc with its smoothed
log-probability; a context has a failure arc with the backoff weight to the context
without its first word. Counts, arcs and weights lie in buckets of hashes on the shared
folder, and a table goes as soon as what follows from it is written. A walk from left to
right adds the weights of the failure arcs it takes and the log-probability of each arc.
In other words, a word's log-probability is a sum: the word's, the weights of the contexts,
and for each n-gram with an arc what this adds to the way by failure. So each n-gram has
one value, a document's score is the sum of the values of its n-grams, and the walk may go
through several automata: tests compare with one walk through a whole automaton.

What fills at least one of every STATES tokens, and so is bounded, is broadcast as an
automaton of numbered states, which texts are walked through. What it lacks is asked for,
as hashes with the document's number, where the values lie, in a shuffle of packed blocks,
and the answers are added up per document. Bit maps of the hashes of arcs, bounded as well,
save most questions about n-grams without an arc; where they fill up, more is asked, with
the same result. Documents are scored in PASSES parts, one after the other, so that the
questions and answers of one part lie on disk at a time.

Words are runs of what is no white space, with A-Z in lower case; each document ends in
an end token, which counts. A missing text has the end alone. Unigrams are discounted by
an absolute amount, and what is taken off is the probability of the one unknown word;
longer n-grams are interpolated with shorter ones. Words and n-grams are told apart by
64-bit hashes.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm.common import mixed, saved, shared_folder
from hitledger.sources.catalog import remove_folder

ORDER = 3
STATES = 4_000_000
LEAST_COUNT = 2
DISCOUNT = 0.5
# Tokens that a task gathers before it packs their counts, and bytes of text per bucket
# of counts.
CHUNK_TOKENS = 1_000_000
BUCKET_BYTES = 16_000_000
# Bytes of packed rows that a task hands over at a time.
BATCH_BYTES = 4_000_000
# Documents whose sums are put together at a time, as a power of two.
BLOCK_BITS = 10
# Parts of the documents, by their ids, that are scored one after the other.
PASSES = 2

# Bits of a map for each arc, and of a map at most, as a power of two.
FILTER_BITS_PER_ARC = 16
FILTER_BITS = 30

# Bytes of text that are hashed at a time.
PIECE = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15


def _powers(factor: int) -> np.ndarray:
    steps = np.full(PIECE, factor, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _byte_values() -> np.ndarray:
    """A number for each byte: 0 for white space, that of the lower case for A-Z."""
    values = mixed(np.arange(1, 257, dtype=np.uint64))
    values[[0x20, *range(0x09, 0x0E)]] = 0
    values[0x41:0x5B] = values[0x61:0x7B]
    return values


_BYTES = _byte_values()
_POWERS, _INVERSES = _powers(_FACTOR), _powers(pow(_FACTOR, -1, 1 << 64))
# The end token, and the context of a document's first word: no word has these by rule.
END, BEGIN = mixed(np.array([1 << 62, 1 << 61], np.uint64)).reshape(2, 1)


def _scaled(q: int, factor: int) -> np.uint64:
    return np.uint64(pow(factor, PIECE * q, 1 << 64))


def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie side by side, and where in `data` they begin.

    A word's hash is made of the sum of its bytes' numbers times powers of a factor.
    `bounds` are where texts begin, and the end. Words may be longer than a piece.
    """
    places, sums, units, inside = [], [], [], False
    for q, at in enumerate(range(0, len(data), PIECE)):
        values = _BYTES[data[at : at + PIECE]]
        solid = values != 0
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        texts = bounds[np.searchsorted(bounds, at) : np.searchsorted(bounds, at + len(values))] - at
        begins[texts] = solid[texts]
        goes_on = inside and solid[0] and not (len(texts) and texts[0] == 0)
        inside = bool(solid[-1])
        where = np.flatnonzero(begins)
        if not len(where):
            continue
        own = np.add.reduceat(values * _POWERS[: len(values)], where) * _scaled(q, _FACTOR)
        if goes_on:
            sums[-1][-1:] += own[:1]
            own, where = own[1:], where[1:]
        if len(where):
            places.append(where + at)
            sums.append(own)
            units.append(_INVERSES[where] * _scaled(q, pow(_FACTOR, -1, 1 << 64)))
    if not places:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return mixed(np.concatenate(sums) * np.concatenate(units)), np.concatenate(places)


def _hashed(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Some rows at a time: which, the hashes of their tokens, and where each row's begin, and the end."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, places, data = column.buffers()
    places = np.frombuffer(places, "<i8")[column.offset : column.offset + len(column) + 1] if len(column) else []
    data = np.frombuffer(data or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(places, places[row] + PIECE, "right")) - 1)
        bounds = places[row : end + 1] - places[row]
        words, where = _word_hashes(data[places[row] : places[end]], bounds)
        numbers = np.diff(np.searchsorted(where, bounds))
        starts = np.concatenate(([0], np.cumsum(numbers + 1)))
        hashes = np.full(starts[-1], END[0], np.uint64)
        hashes[np.arange(len(words)) + np.repeat(np.arange(len(numbers)), numbers)] = words
        yield slice(row, end), hashes, starts
        row = end


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of all words but the last and of all but the first."""
    keys = first + np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(keys), PIECE):
        part = slice(at, at + PIECE)
        keys[part] = mixed(mixed(keys[part]) + second[part])
    return keys


def _before(values: np.ndarray, starts: np.ndarray, first) -> np.ndarray:
    """For each token the value of the one before it, `first` for the first of a document."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[starts[:-1]] = first
    return out


def _slices(sorted_keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The part of each bucket that has any of the keys."""
    shift = np.uint64(65 - buckets.bit_length())
    bounds = np.searchsorted(sorted_keys >> shift, np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        yield b, slice(int(bounds[b]), int(bounds[b + 1]))


def _packed(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones, which shuffles and files compress well."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unpacked(x: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packed_table(schema: str, rows: list[tuple]) -> pa.Table:
    """Rows of a schema of int, long, double and binary; arrays are packed."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    cells = [[_packed(x) if isinstance(x, np.ndarray) else x for x in row] for row in rows]
    columns = list(zip(*cells, strict=True)) or [[]] * len(fields)
    return pa.table(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _joint(table: pa.Table, name: str, kind: str) -> np.ndarray:
    """The arrays of all rows of a binary column, one after the other."""
    size, at = np.dtype(kind).itemsize, 0
    out = np.empty(sum(pa.compute.binary_length(table.column(name)).drop_null().to_pylist()) // size, kind)
    for x in table.column(name):
        if x.is_valid:
            part = _unpacked(x.as_buffer(), kind)
            out[at : at + len(part)] = part
            at += len(part)
    return out


def _batches(schema: str, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """The rows, some BATCH_BYTES at a time."""
    some, held = [], 0
    for row in rows:
        some.append(row)
        held += sum(x.nbytes for x in row if isinstance(x, np.ndarray))
        if held >= BATCH_BYTES:
            yield from _packed_table(schema, some).to_batches()
            some, held = [], 0
    if some:
        yield from _packed_table(schema, some).to_batches()


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, the order of all, and where in it each key starts."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[starts], order, starts


def _summed(counts: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(counts[order].astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)


class Kept:
    """A table in the shared folder that is removed as soon as what follows from it is written."""

    def __init__(self, df: DataFrame, name: str, *parts: str) -> None:
        self.spark, self.path = df.sparkSession, shared_folder(df.sparkSession, name)
        df.write.partitionBy(*parts).option("compression", "zstd").parquet(self.path)
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def remove(self, part: str = "") -> None:
        remove_folder(self.spark, f"{self.path}/{part}" if part else self.path)


_COUNTS = "bucket int, keys binary, counts binary, train binary"


def _word_counter(buckets: int):
    """Counts words in all documents and in training ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, trains, held = [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            found, order, starts = _distinct(np.concatenate(keys))
            keys.clear()
            train = _summed(np.concatenate(trains), order, starts)
            trains.clear()
            counts = np.diff(np.append(starts, len(order)))
            rows = ((b, found[s], counts[s], train[s]) for b, s in _slices(found, buckets))
            yield from _batches(_COUNTS, rows)

        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for rows, hashes, starts in _hashed(batch.column("text")):
                keys.append(hashes)
                trains.append(np.repeat(train[rows], np.diff(starts)))
                held += len(hashes)
                if held >= CHUNK_TOKENS:
                    yield from packed()
                    held = 0
        if held:
            yield from packed()

    return run


_MERGED = f"{_COUNTS}, n_train long, n_known long, ones long, twos long, n_all long"


def _words_merged(key: tuple, table: pa.Table) -> pa.Table:
    """One row per bucket with the sums of all its rows."""
    keys, order, starts = _distinct(_joint(table, "keys", "<u8"))
    counts, train = (_summed(_joint(table, name, "<i8"), order, starts) for name in ("counts", "train"))
    numbers = (train.sum(), (train > 0).sum(), (train == 1).sum(), (train == 2).sum(), counts.sum())
    return _packed_table(_MERGED, [(key[0].as_py(), keys, counts, train, *map(int, numbers))])


_NGRAMS = "bucket int, first binary, second binary, counts binary, n_kept long"


def _by_context(first: np.ndarray) -> np.ndarray:
    """An order with equal contexts side by side, which takes less room."""
    return np.argsort(first)


def _ngram_counter(parts_of, buckets: int):
    """Counts the n-grams of which `parts_of(hashes, starts)` gives the first and second parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, seconds, held = [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            first, second = np.concatenate(firsts), np.concatenate(seconds)
            firsts.clear()
            seconds.clear()
            keys, place, starts = _distinct(_joined(first, second))
            counts = np.diff(np.append(starts, len(first)))
            place = place[starts]
            first, second = first[place], second[place]

            def rows() -> Iterator[tuple]:
                for bucket, s in _slices(keys, buckets):
                    order = _by_context(first[s])
                    yield bucket, first[s][order], second[s][order], counts[s][order], None

            yield from _batches(_NGRAMS, rows())

        for batch in batches:
            for _, hashes, starts in _hashed(batch.column("text")):
                first, second = parts_of(hashes, starts)
                firsts.append(first)
                seconds.append(second)
                held += len(first)
                if held >= CHUNK_TOKENS:
                    yield from packed()
                    held = 0
        if held:
            yield from packed()

    return run


def _ngrams_merged(key: tuple, table: pa.Table) -> pa.Table:
    """One row per bucket with the n-grams that occur LEAST_COUNT times."""
    first, second = _joint(table, "first", "<u8"), _joint(table, "second", "<u8")
    place, starts = _distinct(_joined(first, second))[1:]
    counts = _summed(_joint(table, "counts", "<i8"), place, starts)
    keep = counts >= LEAST_COUNT
    at, counts = place[starts[keep]], counts[keep]
    del place, starts
    order = _by_context(first[at])
    row = (key[0].as_py(), first[at][order], second[at][order], counts[order], int(keep.sum()))
    return _packed_table(_NGRAMS, [row])


@dataclass
class Arcs:
    """A bit map of the hashes of n-grams with an arc: none is missed, some have a bit for nothing."""

    bits: np.ndarray
    power: int

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys >> np.uint64(64 - self.power)).astype(np.int64)
        return (self.bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0

    @classmethod
    def of(cls, ngrams: DataFrame, buckets: int) -> Arcs:
        n = ngrams.agg(F.sum("n_kept")).first()[0] or 0
        inner = buckets.bit_length() - 1
        power = max(inner + 3, min(FILTER_BITS, (FILTER_BITS_PER_ARC * n).bit_length()))

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    keys = _joined(_unpacked(row["first"], "<u8"), _unpacked(row["second"], "<u8"))
                    slots = keys >> np.uint64(64 - power)
                    own = np.zeros(1 << (power - inner), bool)
                    own[(slots & np.uint64(len(own) - 1)).astype(np.int64)] = True
                    out = [(row["bucket"], np.packbits(own).tobytes())]
                    yield from _packed_table("bucket int, bits binary", out).to_batches()

        bits = np.zeros(1 << (power - 3), np.uint8)
        size = len(bits) // buckets
        for r in ngrams.select("bucket", "first", "second").mapInArrow(mapped, "bucket int, bits binary").collect():
            bits[r["bucket"] * size : (r["bucket"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
        return cls(bits, power)


_ASKED_CONTEXTS = "bucket int, origin int, keys binary, total binary, number binary"


def _context_requests(buckets: int):
    """Per bucket of shorter n-grams: those that n-grams here begin or end with, once each.

    With them go the sum and the number of the counts of the n-grams that begin so.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first, second = _unpacked(row["first"], "<u8"), _unpacked(row["second"], "<u8")
                keys, place = np.unique(np.concatenate((first, second)), return_inverse=True)
                place = place[: len(first)]
                total = np.bincount(place, _unpacked(row["counts"], "<i8"), len(keys)).astype("<i8")
                number = np.bincount(place, minlength=len(keys)).astype("<i8")
                out = ((b, row["bucket"], keys[s], total[s], number[s]) for b, s in _slices(keys, buckets))
                yield from _batches(_ASKED_CONTEXTS, out)

    return run


# The n-grams of an order: `adds` is what an arc adds to the way by failure.
_LEVEL = "bucket int, first binary, second binary, counts binary, logs binary, adds binary"

# Rows of three parts. VALUES: what each n-gram that is not broadcast adds to a text's score, as an arc and as the
# context of the next word; of words also the training counts. ANSWERS, per bucket that has
# asked and in the order of its keys. FREQUENT: what is broadcast.
VALUES, ANSWERS, FREQUENT = 0, 1, 2
_PARTS = (
    "part int, bucket int, origin int, keys binary, first binary, second binary, "
    "train binary, logs binary, fails binary, left binary, value binary"
)


def _values(bucket: int, least: int, keys, first, second, counts, train, logs, adds, fails) -> list[tuple]:
    """The rows of a bucket's values and frequent n-grams; `train` only where it differs from counts."""
    keep = (counts >= least) | (keys == BEGIN[0])
    rare = [None if x is None else x[~keep] for x in (keys, train, adds + fails)]
    some = [x[keep] if len(x) else x for x in (keys, first, second, counts if train is None else train, logs, fails)]
    return [
        (VALUES, bucket, None, rare[0], None, None, rare[1], None, None, None, rare[2]),
        (FREQUENT, bucket, None, *some, None, None),
    ]


def _contexts(words: tuple | None, least: int):
    """Weights of the n-grams of a bucket as contexts, and answers for the longer ones.

    `words` are, for the table of words, what their probabilities need: training tokens,
    discount, unknown word's probability, training documents and number of buckets.
    """

    def run(key: tuple, own: pa.Table, asked: pa.Table) -> pa.Table:
        bucket = (own if own.num_rows else asked).column("bucket")[0].as_py()
        counts = _joint(own, "counts", "<i8")
        if words:
            keys, train = _joint(own, "keys", "<u8"), _joint(own, "train", "<i8")
            n_train, discount, unknown, n_docs, buckets = words
            if bucket == int(BEGIN[0] >> np.uint64(65 - buckets.bit_length())):
                at = np.searchsorted(keys, BEGIN[0])
                keys, train = np.insert(keys, at, BEGIN[0]), np.insert(train, at, n_docs)
                counts = np.insert(counts, at, n_docs)
            p = np.where(train > 0, (train - discount) / max(n_train, 1), unknown)
            logs = adds = np.log10(p)
            first = second = np.empty(0, "<u8")
            seen = train
        else:
            first, second = _joint(own, "first", "<u8"), _joint(own, "second", "<u8")
            keys = _joined(first, second)
            order = np.argsort(keys)
            keys, first, second, counts = (x[order] for x in (keys, first, second, counts))
            logs, adds = (_joint(own, name, "<f8")[order] for name in ("logs", "adds"))
            train, seen = None, counts
        wanted = _joint(asked, "keys", "<u8")
        place = np.searchsorted(keys, wanted)
        total = np.bincount(place, _joint(asked, "total", "<i8"), len(keys))
        number = np.bincount(place, _joint(asked, "number", "<i8"), len(keys))
        left = 1 - (total - DISCOUNT * number) / np.maximum(seen, 1)
        fails = np.log10(np.maximum(left, 1e-12))
        rows = _values(bucket, least, keys, first, second, counts, train, logs, adds, fails)
        for origin, asks in zip(asked.column("origin").to_pylist(), asked.column("keys"), strict=True):
            at = np.searchsorted(keys, _unpacked(asks.as_buffer(), "<u8"))
            rows.append((ANSWERS, bucket, origin, *[None] * 3, seen[at], logs[at], None, left[at], None))
        return _packed_table(_PARTS, rows)

    return run


def _arcs(least: int, last: bool):
    """Log-probabilities of the n-grams of a bucket from the answers about their parts."""

    def run(key: tuple, ngrams: pa.Table, answers: pa.Table) -> pa.Table:
        first, second = _joint(ngrams, "first", "<u8"), _joint(ngrams, "second", "<u8")
        counts = _joint(ngrams, "counts", "<i8")
        # What was asked, and the answers in the same order: buckets are ranges of keys.
        known = np.unique(np.concatenate((first, second)))
        answers = answers.sort_by("bucket")
        train, logs, left = (
            _joint(answers, name, kind) for name, kind in (("train", "<i8"), ("logs", "<f8"), ("left", "<f8"))
        )
        context, shorter = np.searchsorted(known, first), np.searchsorted(known, second)
        own = (counts - DISCOUNT) / train[context]
        found = np.log10(own + left[context] * 10 ** logs[shorter])
        adds = found - np.log10(np.maximum(left[context], 1e-12)) - logs[shorter]
        bucket = ngrams.column("bucket")[0].as_py()
        if not last:
            return _packed_table(_LEVEL, [(bucket, first, second, counts, found, adds)])
        keys = _joined(first, second)
        order = np.argsort(keys)
        columns = [x[order] for x in (keys, first, second, counts)]
        rows = _values(bucket, least, *columns, None, found[order], adds[order], np.zeros(len(keys)))
        return _packed_table(_PARTS, rows)

    return run


def _longer(level: Kept, ngrams: Kept, buckets: int, words: tuple | None, least: int, last: bool):
    """The values of the shorter n-grams of `level`, and the level of `ngrams`, or its values."""
    asked = ngrams.rows.mapInArrow(_context_requests(buckets), _ASKED_CONTEXTS)
    parts = level.rows.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_contexts(words, least), _PARTS)
    parts = Kept(parts, "lm-contexts", "part")
    level.remove()
    _released(level.spark)
    answers = parts.rows.where(F.col("part") == ANSWERS).select("origin", "bucket", "train", "logs", "left")
    arcs = ngrams.rows.groupBy("bucket").cogroup(answers.groupBy("origin"))
    if last:
        longer = Kept(arcs.applyInArrow(_arcs(least, last), _PARTS), "lm-values", "part")
    else:
        longer = Kept(arcs.applyInArrow(_arcs(least, last), _LEVEL), "lm-arcs")
    ngrams.remove()
    parts.remove(f"part={ANSWERS}")
    _released(level.spark)
    return parts, longer


def _gathered(parts: Kept) -> dict[str, np.ndarray]:
    """The frequent n-grams of an order, at most STATES, and BEGIN; their table goes."""
    kinds = {"keys": "<u8", "first": "<u8", "second": "<u8", "train": "<i8", "logs": "<f8", "fails": "<f8"}
    rows = parts.rows.where(F.col("part") == FREQUENT).select(*kinds).collect()
    parts.remove(f"part={FREQUENT}")
    return {c: np.concatenate([np.empty(0, k), *(_unpacked(r[c], k) for r in rows)]) for c, k in kinds.items()}


def _found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted key from 1 on, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, place + 1, 0)


@dataclass
class Automaton:
    """The frequent words and n-grams by number from 1 on; state 0 has no context.

    `arcs[k]` are the kept n-grams of k + 2 words, as sorted numbers made of the state of
    the words before (high half) and the last word (low half); `arc_logs[k]` are their
    log-probabilities, `failures[k]` the backoff weights of the states with k + 1 words.
    """

    words: np.ndarray
    train: np.ndarray
    n_train: int
    n_known: int
    unknown: float
    discount: float
    arcs: list[np.ndarray]
    arc_counts: list[np.ndarray]
    arc_logs: list[np.ndarray]
    failures: list[np.ndarray]
    # Of the n-grams of 2, 3, ... words, in the automaton or not.
    maps: list[Arcs] = field(default_factory=list)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities of words by their training counts."""
        n = max(self.n_train, 1)
        return np.where(counts > 0, (counts - self.discount) / n, self.unknown)

    def states(self, ids: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """For each position, the arcs of 2, 3, ... words that end there; 0 for none."""
        before = _before(ids, starts, len(self.words) + 1)
        out = []
        for arcs in self.arcs:
            wanted = (before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)
            some = np.flatnonzero((before > 0) & (ids > 0))
            arc = np.zeros(len(ids), np.int64)
            arc[some] = _found(arcs, wanted[some])
            out.append(arc)
            before = _before(arc, starts, 0)
        return out

    def logs(self, ids: np.ndarray, counts: np.ndarray, states: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
        """The log10-probability of each word as far as it is known here.

        What is not in the automaton adds nothing; its value comes on top.
        """
        with np.errstate(divide="ignore"):
            total = np.where(ids > 0, np.log10(self.unigram(counts)), 0.0)
        before = _before(ids, starts, len(self.words) + 1)
        for arc, logs, failures in zip(states, self.arc_logs, self.failures, strict=False):
            total = np.where(arc > 0, logs[arc], failures[before] + total)
            before = _before(arc, starts, 0)
        return total

    def rare(self, hashes: np.ndarray, ids: np.ndarray, states: list[np.ndarray], starts: np.ndarray):
        """Hashes of the words and n-grams to ask for, and the tokens at which they end."""
        at = [np.flatnonzero(ids == 0)]
        out = [hashes[at[0]]]
        keys, fit = _joined(_before(hashes, starts, BEGIN[0]), hashes), np.ones(len(hashes), bool)
        for k, (arcs, known) in enumerate(zip(self.maps, states, strict=True)):
            if k:
                # An n-gram with an arc has them for its parts.
                fit = fit & _before(fit, starts, False)
                keys = _joined(_before(keys, starts, BEGIN[0]), keys)
            fit = fit & ((known > 0) | arcs.maybe(keys))
            at.append(np.flatnonzero(fit & (known == 0)))
            out.append(keys[at[-1]])
        return np.concatenate(out), np.concatenate(at)

    def add_words(self, found: dict[str, np.ndarray]) -> None:
        """The words of the automaton and their weights as contexts, and that of BEGIN."""
        order = np.argsort(found["keys"])
        keys, train, fails = (found[c][order] for c in ("keys", "train", "fails"))
        own = keys != BEGIN[0]
        self.words, self.train = keys[own], train[own]
        self.failures.append(np.concatenate(([0.0], fails[own], fails[~own] if not own.all() else [0.0])))

    def add_order(self, found: dict[str, np.ndarray], shorter: np.ndarray | None) -> np.ndarray:
        """Arcs one word longer than before; `shorter` and the result are hashes by number."""
        if shorter is None:
            context = _found(self.words, found["first"])
            context[found["first"] == BEGIN[0]] = len(self.words) + 1
            word = _found(self.words, found["second"])
        else:
            order = np.argsort(shorter)
            number = np.concatenate(([0], order + 1))
            context, ending = (number[_found(shorter[order], found[c])] for c in ("first", "second"))
            word = (self.arcs[-1][ending - 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        arcs = (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)
        order = np.argsort(arcs)
        self.arcs.append(arcs[order])
        self.arc_counts.append(found["train"][order])
        self.arc_logs.append(np.concatenate(([0.0], found["logs"][order])))
        self.failures.append(np.concatenate(([0.0], found["fails"][order])))
        return found["keys"][order]


def _released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffles of tables that are saved by now.

    It does so for what the driver's garbage collectors find unused, which else may be long after.
    Spark's listeners hold on to the last query until the next one, so a small one comes first.
    """
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def train(docs: DataFrame, usable: Column, text_col: str = "text", order: int = ORDER):
    """The automaton of what is frequent and the table of all values, from the `usable` documents.

    Words are also counted over all documents, which decides what counts as rare: then no
    rare word, trained or not, can fill a bucket.
    """
    if not 2 <= order <= 3:
        raise ValueError("order must be 2 or 3")
    texts = docs.select(docs[text_col].alias("text"), F.coalesce(usable, F.lit(False)).alias("train"))
    size, n_docs = texts.agg(F.sum(F.octet_length("text")), F.count_if("train")).first()
    # A power of two, so that a bucket is a range of hashes.
    buckets = 1 << max(3, int((size or 0) // BUCKET_BYTES).bit_length())
    words = texts.mapInArrow(_word_counter(buckets), _COUNTS).groupBy("bucket").applyInArrow(_words_merged, _MERGED)
    level = Kept(words, "lm-words")
    sums = level.rows.agg(*[F.sum(c).alias(c) for c in ("n_train", "n_known", "ones", "twos", "n_all")]).first()
    n_train, n_known = sums["n_train"] or 0, sums["n_known"] or 0
    # Only for what is broadcast; arcs need LEAST_COUNT occurrences at any size.
    least = max(LEAST_COUNT, -(-(sums["n_all"] or 0) // STATES))
    ones, twos = sums["ones"] or 0, sums["twos"] or 0
    # What discounting takes off is the unknown word's; an estimate from how many words
    # were seen once and twice.
    discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
    unknown = discount * n_known / n_train if n_train else 1.0
    none = np.empty(0, "<u8")
    _released(docs.sparkSession)
    automaton = Automaton(none, none, n_train, n_known, unknown, discount, [], [], [], [])
    spark = docs.sparkSession
    hashes, values = None, []
    for k in range(order - 1):
        shared = spark.sparkContext.broadcast(automaton.maps)

        def parts_of(hashes: np.ndarray, starts: np.ndarray, shared=shared, k=k) -> tuple[np.ndarray, np.ndarray]:
            first, second = _before(hashes, starts, BEGIN[0]), hashes
            if k:
                keys = _joined(first, second)
                fit = shared.value[0].maybe(keys)
                fit &= _before(fit, starts, False)
                first, second = _before(keys, starts, BEGIN[0])[fit], keys[fit]
            return first, second

        chunks = texts.where("train").mapInArrow(_ngram_counter(parts_of, buckets), _NGRAMS)
        ngrams = Kept(chunks.groupBy("bucket").applyInArrow(_ngrams_merged, _NGRAMS), "lm-ngrams")
        automaton.maps = [*automaton.maps, Arcs.of(ngrams.rows, buckets)]
        _released(spark)
        about = (n_train, discount, unknown, n_docs, buckets) if k == 0 else None
        shorter, level = _longer(level, ngrams, buckets, about, least, k == order - 2)
        if k:
            hashes = automaton.add_order(_gathered(shorter), hashes)
        else:
            automaton.add_words(_gathered(shorter))
        values.append(shorter)
    automaton.add_order(_gathered(level), hashes)
    known = None
    for parts in [*values, level]:
        rows = parts.rows.where(F.col("part") == VALUES).select("bucket", "keys", "train", "value")
        known = rows if known is None else known.unionByName(rows)
    return automaton, known, buckets


_SCORED = (
    "row long, doc_id long, n_tokens long, n_known long, base double, score double, "
    "bucket int, keys binary, fill binary, rows binary, times binary"
)


def _scorer(shared, buckets: int):
    """Per document what the automaton knows, and per bucket what is to be asked for.

    Rows that ask are numbered from the first one, `row`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: Automaton = shared.value
        known_counts = np.concatenate(([0], a.train))
        asked, askers, held = [], [], 0

        def requests() -> Iterator[pa.RecordBatch]:
            keys, rows = np.concatenate(asked), np.concatenate(askers)
            asked.clear()
            askers.clear()
            base = int(rows.min())
            order = np.lexsort((rows, keys))
            keys, rows = keys[order], (rows[order] - base).astype("<u4")
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            first = new.copy()
            first[1:] |= rows[1:] != rows[:-1]
            times = np.diff(np.append(np.flatnonzero(first), len(keys))).astype("<u4")
            rows, new = rows[first], np.flatnonzero(new[first])
            keys, ends = keys[first][new], np.append(new, len(rows))
            fill = np.diff(ends).astype("<u4")

            def out() -> Iterator[tuple]:
                for b, s in _slices(keys, buckets):
                    own = slice(int(ends[s.start]), int(ends[s.stop]))
                    yield base, *[None] * 5, b, keys[s], fill[s], rows[own], times[own]

            yield from _batches(_SCORED, out())

        for batch in batches:
            rows, ids = batch.column("row").to_numpy(), batch.column("doc_id").to_pylist()
            for some, hashes, starts in _hashed(batch.column("text")):
                word_ids = _found(a.words, hashes)
                counts = known_counts[word_ids]
                states = a.states(word_ids, starts)
                sums = [
                    np.add.reduceat(x, starts[:-1]).tolist()
                    for x in (
                        (counts > 0).astype(np.int64),
                        np.where(word_ids > 0, np.log10(counts + 1.0), 0.0),
                        a.logs(word_ids, counts, states, starts),
                    )
                ]
                own = rows[some]
                # They go along with the questions to one of the buckets, mixed as numbers of
                # rows begin with that of the task.
                others = (mixed((own >> BLOCK_BITS).astype(np.uint64)) % np.uint64(buckets)).tolist()
                columns = (own.tolist(), ids[some], np.diff(starts).tolist(), *sums, others)
                out = [(*row, *[None] * 4) for row in zip(*columns, strict=True)]
                yield from _packed_table(_SCORED, out).to_batches()
                rare, at = a.rare(hashes, word_ids, states, starts)
                if len(rare):
                    asked.append(rare)
                    askers.append(np.repeat(own, np.diff(starts))[at])
                    held += len(rare)
                if held >= CHUNK_TOKENS:
                    yield from requests()
                    held = 0
        if asked:
            yield from requests()

    return run


_ANSWERS = (
    "block long, row long, doc_id long, n_tokens long, known long, own_base double, own_score double, "
    "rows binary, n_known binary, base binary, score binary"
)
_TOTALS = "doc_id long, n_tokens long, n_known long, base double, score double"


def _answers(key: tuple, values: pa.Table, asked: pa.Table) -> pa.Table:
    """What the rare words and n-grams of a bucket add to the documents, a row per block of them.

    The documents' own rows pass through. One task's questions are answered after the other.
    """
    own = asked.filter(pa.compute.is_null(asked.column("keys")))
    asked = asked.filter(pa.compute.is_valid(asked.column("keys")))
    levels = []
    for hashes, adds, train in zip(*(values.column(c) for c in ("keys", "value", "train")), strict=True):
        counts = _unpacked(train.as_buffer(), "<i8") if train.is_valid else None
        levels.append((_unpacked(hashes.as_buffer(), "<u8"), _unpacked(adds.as_buffer(), "<f8"), counts))
    out = []
    for base, *packed in zip(*(asked.column(c) for c in ("row", "keys", "fill", "rows", "times")), strict=True):
        keys, fill, rows, times = (
            _unpacked(x.as_buffer(), kind) for x, kind in zip(packed, ("<u8", "<u4", "<u4", "<u4"), strict=True)
        )
        count, value = np.zeros(len(keys), np.int64), np.zeros(len(keys))
        for hashes, adds, counts in levels:
            place = _found(hashes, keys)
            at = np.flatnonzero(place)
            value[at] += adds[place[at] - 1]
            if counts is not None:
                count[at] = counts[place[at] - 1]
        found, place = np.unique(rows, return_inverse=True)
        sums = [
            np.bincount(place, np.repeat(w, fill) * times, len(found)).astype("<f8")
            for w in (count > 0, np.log10(count + 1.0), value)
        ]
        found = found.astype("<i8") + base.as_py()
        blocks, first = np.unique(found >> BLOCK_BITS, return_index=True)
        for block, s in zip(blocks, map(slice, first, [*first[1:], len(found)]), strict=True):
            out.append((int(block), *[None] * 6, *[x[s] for x in (found, *sums)]))
    names = ["row", "doc_id", "n_tokens", "n_known", "base", "score"]
    for r in own.select(names).to_pylist():
        out.append((r["row"] >> BLOCK_BITS, *[r[n] for n in names], *[None] * 4))
    return _packed_table(_ANSWERS, out)


def _totals(key: tuple, table: pa.Table) -> pa.Table:
    """The documents of a block with what all buckets have answered."""
    own = table.filter(pa.compute.is_valid(table.column("row")))
    order = np.argsort(own.column("row").to_numpy(), kind="stable")
    rows = own.column("row").to_numpy()[order]
    place = np.searchsorted(rows, _joint(table, "rows", "<i8"))
    total = {}
    for name, before in (("n_known", "known"), ("base", "own_base"), ("score", "own_score")):
        more = np.bincount(place, _joint(table, name, "<f8"), len(rows))
        total[name] = own.column(before).to_numpy()[order] + more
    return pa.table(
        [
            own.column("doc_id").combine_chunks().take(pa.array(order)),
            own.column("n_tokens").combine_chunks().take(pa.array(order)),
            pa.array(np.round(total["n_known"]).astype(np.int64)),
            pa.array(total["base"]),
            pa.array(total["score"]),
        ],
        names=[c.split()[0] for c in _TOTALS.split(", ")],
    )


def scores(
    docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER
) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    The model is learnt from the `usable` documents. `base_score` is the sum of
    log10((c + 1) / (N + V + 1)): c the training count of each token, N that of all
    tokens and V that of different ones. Each row is a document of its own, repeated ids and
    texts too; a missing text is empty, an empty table gives no rows, and without training
    documents both scores are 0.
    """
    spark = docs.sparkSession
    automaton, values, buckets = train(docs, usable, text_col, order)
    shared = spark.sparkContext.broadcast(automaton)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    total = automaton.n_train + automaton.n_known + 1

    def scored(part: int) -> DataFrame:
        rows = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(PASSES)) == part)
        rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        asked = rows.mapInArrow(_scorer(shared, buckets), _SCORED)
        answers = values.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_answers, _ANSWERS)
        # A block holds at most 2^BLOCK_BITS documents that one task has read.
        totals = answers.groupBy("block").applyInArrow(_totals, _TOTALS)
        found = totals.select(
            "doc_id",
            "n_tokens",
            "n_known",
            F.lit(automaton.n_train).cast("long").alias("train_tokens"),
            (F.col("base") - F.col("n_tokens") * F.log10(F.lit(float(total)))).alias("base_score"),
            "score",
        )
        return saved(found, "lm-scores")

    scores = None
    for part in range(PASSES):
        some = scored(part)
        _released(spark)
        scores = some if scores is None else scores.unionByName(some)
    return scores
