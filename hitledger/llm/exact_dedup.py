"""Exact deduplication by two passes over a Bloom filter, in DataFrame functions.

The first pass counts how often every slot of the filter is hit and keeps, as
bitmaps, the slots hit by two rows or more. The second pass tests each row: only
when both of its slots were hit again can its text be a repeated one. Those rows
are shuffled and grouped by the digest of their text; all others are unique and
pass straight through. The filter decides who is shuffled, never the result.

Two texts are equal when they are the same after deleting white space (space and
the control characters tab to carriage return). A missing text counts as empty,
so all missing, empty and blank texts are equal. Of equal texts the one with the
most code points stays, then the one with the smallest id (a missing id comes
first), then any one: rows that repeat an id and its text are one kept row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import saved

BITS_PER_ROW = 16
# Bound of the filter that is broadcast: 2^30 bits are 128 MB. Beyond some 10^8
# rows it fills up: more rows are shuffled, the result stays the same.
MAX_BITS = 1 << 30
MIN_BITS = 1 << 18


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _with_slots(rows: DataFrame, bits: int) -> DataFrame:
    word = F.xxhash64("_sha")
    return rows.withColumn("_slot1", word.bitwiseAND(F.lit(bits - 1))).withColumn(
        "_slot2", F.shiftrightunsigned(word, 32).bitwiseAND(F.lit(bits - 1))
    )


def _filter_bits(rows: int) -> int:
    wanted = max(rows * BITS_PER_ROW, MIN_BITS)
    return min(1 << (wanted - 1).bit_length(), MAX_BITS)


def repeated_slots(digests: DataFrame, bits: int) -> DataFrame:
    """Bitmaps (bucket, bits) of the slots that at least two rows hit.

    Counts are combined before the shuffle, so a text that fills a third of the
    rows sends one row per task.
    """
    return (
        _with_slots(digests, bits)
        .select(F.explode(F.array_distinct(F.array("_slot1", "_slot2"))).alias("slot"))
        .groupBy("slot")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )


def with_candidates(rows: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Rows with `_maybe`: whether both slots of their digest were hit again."""

    def looked_up(frame: DataFrame, slot: str) -> DataFrame:
        # At most bits / 32768 rows of 4 KB: MAX_BITS bounds what is broadcast.
        side = F.broadcast(
            bitmaps.select(F.col("bucket").alias(f"{slot}_bucket"), F.col("bits").alias(f"{slot}_bits"))
        )
        position = F.bitmap_bit_position(slot)
        byte = F.substr(F.col(f"{slot}_bits"), (position / 8).cast("int") + 1, F.lit(1))
        number = F.conv(F.hex(byte), 16, 10).cast("int")
        power = F.pow(F.lit(2), position % 8).cast("int")
        hit = F.coalesce(number.bitwiseAND(power) != 0, F.lit(False))
        return (
            frame.join(side, F.bitmap_bucket_number(slot) == F.col(f"{slot}_bucket"), "left")
            .withColumn(f"{slot}_hit", hit)
            .drop(f"{slot}_bucket", f"{slot}_bits", slot)
        )

    tested = looked_up(looked_up(_with_slots(rows, bits), "_slot1"), "_slot2")
    return tested.withColumn("_maybe", F.col("_slot1_hit") & F.col("_slot2_hit")).drop(
        "_slot1_hit", "_slot2_hit"
    )


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, digest of the normalized text, code points and a row number."""
    text = docs[text_col]
    return docs.select(
        docs[id_col].alias("_id"),
        F.sha2(normalized(text).cast("binary"), 256).alias("_sha"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("_long"),
        F.monotonically_increasing_id().alias("_row"),
    )


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too: id, keep_id, group_size, kept, text_sha256."""
    rows = saved(digests(docs, id_col, text_col), "dedup-digests")
    bits = _filter_bits(rows.count())
    bitmaps = saved(repeated_slots(rows, bits), "dedup-filter")
    tested = with_candidates(rows, bitmaps, bits)
    order = F.struct(-F.col("_long"), F.col("_id"), F.col("_row"))
    groups = saved(
        tested.where("_maybe")
        .groupBy("_sha")
        .agg(F.count("*").alias("_size"), F.min(order).alias("_first"))
        .where("_size > 1"),
        "dedup-groups",
    )
    first = groups.select(
        F.col("_sha"),
        "_size",
        F.col("_first._id").alias("_keep"),
        F.col("_first._row").alias("_keep_row"),
    )
    # Both sides of this join come from a shuffle of their own, so that adaptive
    # execution can split a digest that fills a third of the rows.
    repeated = tested.where("_maybe").join(first, "_sha", "left")
    alone = F.col("_size").isNull()
    grouped = repeated.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    unique = tested.where("not _maybe").select(
        F.col("_id").alias(id_col),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return unique.unionByName(grouped)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, whole and with the columns of `docs`.

    Rows that cannot be repeated are not shuffled. The others are combined per
    text before their shuffle, so that a hot text sends one row per task.
    """
    columns = docs.columns
    packed = docs.select(
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(columns)]).alias("_doc"),
        F.sha2(normalized(docs[text_col]).cast("binary"), 256).alias("_sha"),
        F.coalesce(F.length(docs[text_col]), F.lit(0)).alias("_long"),
        docs[id_col].alias("_id"),
    )
    hashes = saved(packed.select("_sha"), "dedup-digests")
    bits = _filter_bits(hashes.count())
    bitmaps = saved(repeated_slots(hashes, bits), "dedup-filter")
    tested = with_candidates(packed, bitmaps, bits)
    order = F.struct(F.col("_long"), F.col("_id").isNull(), -F.col("_id"))
    best = tested.where("_maybe").groupBy("_sha").agg(F.max_by("_doc", order).alias("_doc"))
    kept = tested.where("not _maybe").select("_doc").unionByName(best.select("_doc"))
    return kept.select(*[F.col(f"_doc.c{i}").alias(c) for i, c in enumerate(columns)])
