"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.sources.scratch import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Entries a Python worker remembers before it starts anew.
MEMO_SIZE = 200_000
# Rows that Spark sends to a Python worker at a time, unless the session says otherwise.
ARROW_ROWS = 500
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver found it.

    On a cluster the package is installed or shipped with the job; this serves workers
    that share the driver's file system but not its search path.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def short_batches(spark: SparkSession) -> SparkSession:
    """Let Spark send whole texts to Python workers ARROW_ROWS rows at a time, not 10,000.

    Both the executor and the worker keep the buffers of the largest batch they have had.
    A size that the session was given stays.
    """
    if spark.conf.get(_ARROW_ROWS, None) is None:
        spark.conf.set(_ARROW_ROWS, str(ARROW_ROWS))
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share, until `scratch.clear`."""
    return scratch_path(spark, name)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again.

    Later steps then depend on files that outlive an executor, and a frame that
    is used several times is computed once.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower case of A-Z only."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo `divisor`; of a missing key, of the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def with_free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of an Arrow text column, a few rows copied at a time; a missing text is empty."""
    for at in range(0, len(column), 200):
        for text in column.slice(at, 200).cast(pa.binary()).to_pylist():
            yield text or b""


def give_back() -> None:
    """Return what Arrow holds unused in this Python worker; for the end of a task."""
    pa.default_memory_pool().release_unused()


_memories: list[WordHashes] = []


def forget_words() -> None:
    """Drop the words that operators before this one remember in this Python worker."""
    for memory in _memories:
        memory.clear()


class WordHashes(dict):
    """64-bit hashes of byte words, remembered up to MEMO_SIZE of them."""

    def __init__(self) -> None:
        super().__init__()
        _memories.append(self)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_SIZE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
