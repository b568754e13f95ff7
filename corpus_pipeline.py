"""The training-data pipeline: from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet
and read again as the next one's documents. All but the last keep the columns of the
documents. A stage works on every document that its predecessor kept:

1. language ID drops documents of no language and writes the predicted language into
   `lang`; the model is learnt from the documents' own labels, except those that the
   held-out rule sets aside,
2. exact dedup keeps one document of each group of equal texts,
3. near dedup keeps one of each group of near copies (five-word shingles, 0.8),
4. decontamination drops documents that are mostly benchmark passages and cuts the
   passages from the others,
5. packing cuts the documents' tokens into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm import decontamination, exact_dedup, language_id, near_dedup, packing
from hitledger.llm.common import crc_remainder, ready, saved, short_batches
from hitledger.llm.queries import WORD_TOKENIZER, table, tokenizer_path

# Words that a worker keeps the ids of in packing: the executors' JVMs have grown by then.
REMEMBERED = 200_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(ready(spark))
    model = language_id.train(docs, crc_remainder(F.col("doc_id"), 5) != 0)
    return language_id.accepted(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(ready(spark))
    return near_dedup.near_deduplicated(docs, size=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(ready(spark))
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(ready(spark))
    name, borders = WORD_TOKENIZER
    return packing.packed(packing.pieces(docs, tokenizer_path(name), borders, remembered=REMEMBERED))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", remove_benchmark),
    ("packing", pack),
]

# A classifier and hashed candidates are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
