"""Token ids as flat binary files.

A folder holds, for each part, `<part>.tokens` with the ids of its documents one after
the other as little-endian unsigned integers (16 bits if the vocabulary fits, else 32),
`<part>.starts` with the place of each document within the part and the part's end as
64-bit integers, and `<part>.ids` with the document ids as 64-bit integers, the least
one for a missing id. The index, a Parquet table in `index`, names the parts in order
with their base: the number of tokens in all parts before, a prefix sum. A document's
offset in the whole is its part's base plus its start.

Parts follow each other in ascending document id; a missing id comes first, and rows
that repeat an id are ordered by a hash of their text. A missing text is empty and, as
each document, ends in the end id. Files of a task that was run twice carry different
names, and the index names those that count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitledger.llm.common import text_bytes
from hitledger.llm.tokens import encoder

MISSING_ID = -(1 << 63)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    borders: str | None = None,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode `docs` into the folder `path`, which all executors must reach.

    Texts are dealt out by ranges of ids, the hash of the text being part of the key, so
    that even one id with very many rows fills several parts; only ids and texts move.
    """
    keyed = docs.select(
        docs[id_col].cast("long").alias("id"),
        docs[text_col].alias("text"),
        F.xxhash64(docs[text_col]).alias("tie"),
    )
    ordered = keyed.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").drop("tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        encode = encoder(tokenizer, borders)
        end = np.array([end_id], encode.dtype).tobytes()
        files, folder = fs.FileSystem.from_uri(path)
        files.create_dir(folder)
        at = rows = 0
        with (
            files.open_output_stream(f"{folder}/{part}.tokens") as tokens,
            files.open_output_stream(f"{folder}/{part}.starts") as starts,
            files.open_output_stream(f"{folder}/{part}.ids") as ids,
        ):
            for batch in batches:
                begins = []
                for text in text_bytes(batch.column("text")):
                    begins.append(at)
                    found = encode.encode(text)
                    tokens.write(found)
                    tokens.write(end)
                    at += len(found) // encode.dtype.itemsize + 1
                starts.write(np.array(begins, "<i8").tobytes())
                ids.write(batch.column("id").fill_null(MISSING_ID).to_numpy().astype("<i8").tobytes())
                rows += batch.num_rows
            starts.write(np.array([at], "<i8").tobytes())
        yield pa.RecordBatch.from_pydict(
            {
                "number": [task.partitionId()],
                "part": [part],
                "width": [encode.dtype.itemsize],
                "n_docs": [rows],
                "n_tokens": [at],
            }
        )

    schema = "number long, part string, width long, n_docs long, n_tokens long"
    ordered.mapInArrow(write, schema).write.parquet(f"{path}/parts")
    # One row per part: the window is over the list of files, not over documents.
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    parts = docs.sparkSession.read.schema(schema).parquet(f"{path}/parts").where("n_docs > 0")
    parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(
        f"{path}/index"
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32.

    Local files are mapped into memory; a store of another kind is read. The checksum is
    that of the ids as little-endian unsigned 32-bit integers, whatever the files' width.
    """
    index = spark.read.parquet(f"{path}/index")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = fs.FileSystem.from_uri(path)

        def whole(name: str) -> np.ndarray:
            place = f"{folder}/{name}"
            if isinstance(files, fs.LocalFileSystem):
                buffer = pa.memory_map(place).read_buffer()
            else:
                buffer = files.open_input_file(place).read_buffer()
            return np.frombuffer(buffer, np.uint8)

        for batch in batches:
            for row in batch.to_pylist():
                tokens = whole(f"{row['part']}.tokens").view(f"<u{row['width']}")
                starts = whole(f"{row['part']}.starts").view("<i8")
                ids = whole(f"{row['part']}.ids").view("<i8")
                bounds = starts.tolist()
                for first in range(0, len(ids), 10_000):
                    last = min(first + 10_000, len(ids))
                    crcs = [
                        zlib.crc32(tokens[a:b].astype("<u4").tobytes())
                        for a, b in zip(bounds[first:last], bounds[first + 1 : last + 1], strict=True)
                    ]
                    own = ids[first:last]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own, pa.int64(), mask=own == MISSING_ID),
                            pa.array(starts[first:last] + row["base"], pa.int64()),
                            pa.array(np.diff(starts[first : last + 1]), pa.int64()),
                            pa.array(crcs, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    spread = index.repartition(max(1, index.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_tokens(path: str, part: str, width: int, row: int) -> np.ndarray:
    """The ids of one document of a local folder, mapped and not copied."""
    _, folder = fs.FileSystem.from_uri(path)
    starts = np.memmap(f"{folder}/{part}.starts", "<i8", "r")
    tokens = np.memmap(f"{folder}/{part}.tokens", f"<u{width}", "r")
    return tokens[starts[row] : starts[row + 1]]
