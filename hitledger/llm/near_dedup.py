"""Near-duplicate documents by min-max hashing.

A document is the set of its word shingles. Under each of a number of permutations of
the shingles both the least and the greatest are kept: two values of the signature for
one evaluation of a hash. Bands of four values put documents that share a band into one
bucket; two documents of similarity 0.8 share none of the bands with a probability of
3 in a million. Sizes and parities of the sets rule out what cannot be similar enough,
without error; other candidates are confirmed on their full sets, so that the signature
decides what is compared and never what is linked.

Documents of equal sets are one class, compared once. In a bucket all classes are first
compared with one of them, then with another one, a few times; that links a large group
of near copies in a number of comparisons that grows with its size and not with its
square. What these stars leave apart is compared pair by pair, only between different
components: a pair inside one would add nothing.

Words are runs of what is no white space (space, tab to carriage return), with A-Z in
lower case. A text of fewer words than a shingle has one shingle, the whole; one without
words, or a missing one, has none and is linked with nothing. Sets hold 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm import exact_dedup
from hitledger.llm.common import WordHashes, forget_words, give_back, mixed, saved, text_bytes
from hitledger.llm.components import components

PERMUTATIONS = 48
BAND_VALUES = 4
# 64-bit words of the parities that rule out pairs before their sets are fetched.
PARITY_WORDS = 16
# Times that each bucket's classes are compared with one of them.
STAR_TURNS = 2
# Members of a bucket in one block, where all that is apart is compared.
BLOCK = 64

_rng = np.random.default_rng(20240)
_FACTORS = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SEEDS = _rng.integers(0, 1 << 63, 2 * PERMUTATIONS // BAND_VALUES, dtype=np.uint64)

_hashes = WordHashes()


def shingles(text: bytes, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit numbers."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = _hashes.of(words)
    n = max(len(h) - size + 1, 1)
    size = min(size, len(h))
    mix = mixed(h[:n] + np.uint64(size))
    for i in range(1, size):
        mix = mixed(mix + h[i : i + n])
    return np.unique(mix)


def bands(found: np.ndarray) -> np.ndarray:
    """A number per band; each mixes two least and two greatest values."""
    least = np.empty(PERMUTATIONS, np.uint64)
    greatest = np.empty(PERMUTATIONS, np.uint64)
    for i, factor in enumerate(_FACTORS):
        order = found * factor
        least[i], greatest[i] = order.min(), order.max()
    # The halves of a band come from different permutations.
    values = np.concatenate((least, np.roll(greatest, 1))).reshape(BAND_VALUES, -1)
    key = _BAND_SEEDS.copy()
    for row in values:
        key = mixed(key + row)
    return key


def parity(found: np.ndarray) -> np.ndarray:
    """For each place that shingles hash to, whether their number is odd, as bits of words."""
    bits = 64 * PARITY_WORDS
    odd = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, keys, parities = [], [], [], [], []
            for text in text_bytes(batch.column("text")):
                found = shingles(text, size)
                sizes.append(len(found))
                first.append(int(found.sum(dtype=np.uint64)) - (1 << 63))
                second.append(int(np.bitwise_xor.reduce(mixed(found))) - (1 << 63) if len(found) else 0)
                keys.append(bands(found).view(np.int64) if len(found) else None)
                parities.append(parity(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(parities, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "set1", "set2", "bands", "parity"],
            )
        forget_words()
        give_back()

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text, size).tobytes() for text in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(found, pa.binary())], names=["node", "shingles"]
            )
        forget_words()
        give_back()

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            # A few pairs at a time: sets of very long texts take megabytes each.
            for at in range(0, batch.num_rows, 50):
                part = batch.slice(at, 50)
                sets = (part.column(c).to_pylist() for c in ("set_a", "set_b"))
                for x, y in zip(*sets, strict=True):
                    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * both >= percent * (len(p) + len(q) - both))
            links = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield links.filter(pa.array(keep, pa.bool_()))
        give_back()

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    pairs = saved(pairs, "near-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = sets.join(saved(nodes, "near-nodes"), "node", "left_semi")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    with_sets = pairs.join(left, "a").join(right, "b")
    confirmed = with_sets.select("a", "b", "set_a", "set_b").mapInArrow(
        _confirmed(percent), "a long, b long"
    )
    return saved(confirmed, "near-links")


def near_duplicates(
    docs: DataFrame,
    size: int = 2,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, kept.

    `component_id` is the smallest id that links lead to, the document's own included; a
    document is kept when that is its own id. Rows that repeat an id and its text share
    one fate. A missing id counts as the greatest.
    """
    spark = docs.sparkSession
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        docs[text_col].alias("text"),
        F.xxhash64(docs[text_col]).alias("text_hash"),
    )
    signed = saved(
        rows.mapInArrow(
            _signatures(size),
            "doc_id long, text_hash long, n_shingles long, set1 long, set2 long, "
            "bands array<long>, parity array<long>",
        ),
        "near-signatures",
    )
    key = ["n_shingles", "set1", "set2"]
    # A class of equal sets is one row; a class that fills a third of the rows is
    # combined before the shuffle. Its node is a number of this run.
    classes = saved(
        signed.where("n_shingles > 0")
        .groupBy(*key)
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"),
            F.min_by(F.struct("bands", "parity"), "text_hash").alias("signature"),
        )
        .select(
            *key,
            F.col("first.doc_id").alias("least"),
            F.col("first.text_hash").alias("text_hash"),
            "signature.bands",
            "signature.parity",
            F.monotonically_increasing_id().alias("node"),
        ),
        "near-classes",
    )
    members = classes.select(F.explode("bands").alias("bucket"), "node")
    crowded = saved(
        members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "near-crowded"
    )
    shared = saved(members.join(crowded, "bucket"), "near-buckets")
    # The texts of the classes that meet another one in some bucket are read again.
    parities = [F.element_at("parity", i + 1).alias(f"p{i}") for i in range(PARITY_WORDS)]
    sketch = F.struct(F.col("n_shingles").alias("n"), *parities).alias("sketch")
    meeting = classes.join(shared.select("node").distinct(), "node", "left_semi")
    active = saved(meeting.select("node", "bands", sketch, "least", "text_hash"), "near-active")
    wanted = active.select(F.col("least").alias("doc_id"), "text_hash", "node")
    # Most texts are not wanted; a bit map tells them before anything is shuffled.
    wanted = saved(wanted, "near-wanted")
    maybe = _maybe_among(rows.withColumn("_sha", F.xxhash64("doc_id", "text_hash")), wanted).where("_maybe")
    texts = maybe.join(
        wanted,
        maybe.doc_id.eqNullSafe(wanted.doc_id) & (maybe.text_hash == wanted.text_hash),
    )
    found = texts.select("node", "text").mapInArrow(_sets(size), "node long, shingles binary")
    sets = saved(found.dropDuplicates(["node"]), "near-sets")
    active = active.select("node", "bands", "sketch")
    linked = sets.select("node", F.col("node").alias("component"))
    for turn in range(STAR_TURNS):
        pairs = _star_pairs(shared, linked, active, percent, turn)
        links = _links(pairs, sets, percent)
        if links.isEmpty():
            break
        linked = _joined(linked, links)
    links = _links(_cross_pairs(shared, linked, active, percent), sets, percent)
    linked = _joined(linked, links)
    owners = classes.select(*key, "node", "least").join(linked, "node", "left")
    owners = owners.withColumn("component", F.coalesce("component", "node"))
    ids = owners.groupBy("component").agg(F.min("least").alias("component_id"))
    owners = saved(
        owners.join(saved(ids, "near-ids"), "component").select(*key, "component_id"), "near-owners"
    )
    found = signed.drop("bands", "parity").join(owners, key, "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _maybe_among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """`rows` with `_maybe`: false only where `_sha` is none of wanted's (doc_id, text_hash).

    The bit map has the bound of exact dedup's filter; as it fills, more rows are true.
    """
    bits = exact_dedup._filter_bits(wanted.count())
    keys = exact_dedup._with_slots(wanted.select(F.xxhash64("doc_id", "text_hash").alias("_sha")), bits)
    bitmaps = (
        keys.select(F.explode(F.array("_slot1", "_slot2")).alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    return exact_dedup.with_candidates(rows, saved(bitmaps, "near-bitmap"), bits)


def _joined(linked: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) with `links` added."""
    if links.isEmpty():
        return linked
    a = linked.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = linked.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    between = links.join(a, "a").join(b, "b").where("ca <> cb")
    merged = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("into"))
    return saved(
        linked.join(merged, "component", "left").select(
            "node", F.coalesce("into", "component").alias("component")
        ),
        "near-linked",
    )


def _placed(shared: DataFrame, linked: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component, with their own."""
    placed = shared.join(linked, "node")
    mixed_buckets = saved(
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("bucket"),
        "near-mixed",
    )
    return placed.join(mixed_buckets, "bucket")


def _star_pairs(
    shared: DataFrame, linked: DataFrame, active: DataFrame, percent: int, turn: int
) -> DataFrame:
    """Pairs of one member of each bucket, another one each turn, and all others apart from it."""
    placed = saved(_placed(shared, linked), "near-placed")
    centres = saved(
        placed.groupBy("bucket")
        .agg(
            F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "component")).alias("c")
        )
        .select("bucket", F.col("c.node").alias("a"), F.col("c.component").alias("component_a")),
        "near-stars",
    )
    pairs = (
        placed.join(centres, "bucket")
        .where(F.col("component") != F.col("component_a"))
        .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        .distinct()
    )
    of_a = active.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    of_b = active.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    sketched = saved(pairs, "near-star-pairs").join(of_a, "a").join(of_b, "b")
    return sketched.where(_may_match(percent, "sketch_a", "sketch_b")).select("a", "b")


def _may_match(percent: int, of_a: str, of_b: str) -> Column:
    """What holds for every pair that is similar enough: near sizes and near parities.

    Each shingle of one set alone flips one bit of the parities, so they differ in no
    more bits than there are such shingles; and those are at most (100 - percent) /
    (100 + percent) of the sum of sizes.
    """
    size_a, size_b = F.col(f"{of_a}.n"), F.col(f"{of_b}.n")
    near_sizes = 100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)
    apart = sum(
        F.bit_count(F.col(f"{of_a}.p{i}").bitwiseXOR(F.col(f"{of_b}.p{i}"))) for i in range(PARITY_WORDS)
    )
    return near_sizes & ((100 + percent) * apart <= (100 - percent) * (size_a + size_b))


def _cross_pairs(
    shared: DataFrame, linked: DataFrame, active: DataFrame, percent: int
) -> DataFrame:
    """All pairs that share a bucket, lie in different components and may be similar.

    The members outside a bucket's largest component meet all others. A pair comes out
    once, in the first of its buckets. Large buckets are cut into blocks that meet each
    other by a join on (bucket, block, block), so no task gathers one.
    """
    placed = saved(_placed(shared, linked), "near-open")
    main = saved(
        placed.groupBy("bucket", "component")
        .agg(F.count("*").alias("own"))
        .groupBy("bucket")
        .agg(F.max_by("component", F.struct("own", "component")).alias("main"), F.max("own").alias("own")),
        "near-main",
    )
    placed = saved(placed.join(main, "bucket"), "near-placed").join(active, "node")
    n_left = F.ceil((F.col("n") - F.col("own")) / BLOCK).cast("int")
    n_right = F.ceil(F.col("n") / BLOCK).cast("int")

    def block(count: Column) -> Column:
        return F.pmod(F.xxhash64("node"), count).cast("int")

    left = placed.where("component <> main").select(
        "bucket", F.col("node").alias("a"), F.col("component").alias("component_a"),
        F.col("sketch").alias("sketch_a"), F.col("bands").alias("bands_a"),
        block(n_left).alias("i"), F.explode(F.sequence(F.lit(0), n_right - 1)).alias("j"),
    )
    right = placed.select(
        F.col("bucket").alias("bucket_b"), F.col("node").alias("b"), "main",
        F.col("component").alias("component_b"), F.col("sketch").alias("sketch_b"),
        F.col("bands").alias("bands_b"),
        block(n_right).alias("j_b"), F.explode(F.sequence(F.lit(0), n_left - 1)).alias("i_b"),
    )
    # Equal bands have equal places, as each band mixes in a number of its own.
    first = F.element_at(F.array_intersect("bands_a", "bands_b"), 1)
    met = left.join(
        right,
        (F.col("bucket") == F.col("bucket_b"))
        & (F.col("i") == F.col("i_b"))
        & (F.col("j") == F.col("j_b"))
        & (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("main")) | (F.col("a") < F.col("b")))
        & _may_match(percent, "sketch_a", "sketch_b")
        & (first == F.col("bucket")),
    )
    return met.select("a", "b").distinct()


def near_deduplicated(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`docs` without the near copies: of each component the smallest id stays.

    Rows without an id are never dropped.
    """
    found = near_duplicates(docs, size, percent, id_col, text_col)
    dropped = saved(
        found.where("not kept and doc_id is not null").select("doc_id", "text_hash").distinct(),
        "near-dropped",
    )
    packed = docs.select(
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_doc"),
        docs[id_col].cast("long").alias("_id"),
        F.xxhash64(docs[text_col]).alias("_hash"),
    )
    tested = _maybe_among(packed.withColumn("_sha", F.xxhash64("_id", "_hash")), dropped)
    # Only rows that may be dropped are shuffled.
    gone = (F.col("_id") == dropped.doc_id) & (F.col("_hash") == dropped.text_hash)
    kept = tested.where("_maybe").join(dropped, gone, "left_anti").select("_doc")
    kept = tested.where("not _maybe").select("_doc").unionByName(kept)
    return kept.select(*[F.col(f"_doc.c{i}").alias(c) for i, c in enumerate(docs.columns)])
