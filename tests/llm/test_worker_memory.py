"""What Python workers are sent at a time, and what they keep."""

import public_tokenizers
import pyarrow as pa
import pytest
from helpers import PROSE

import corpus_pipeline
from hitledger.llm import near_dedup
from hitledger.llm.common import ARROW_ROWS
from hitledger.llm.tokens import Encoder

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def largest_batch(spark) -> int:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return spark.range(0, 5 * ARROW_ROWS, 1, 1).mapInArrow(run, "n long").groupBy().max("n").first()[0]


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "exact dedup"], ids=lambda s: s[0])
def test_stages_send_few_rows_at_a_time(spark, tmp_path, stage):
    docs = spark.createDataFrame([(1, PROSE[0], "en", 1)], "doc_id long, text string, lang string, n_chars int")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.conf.unset(ROWS)
    try:
        assert largest_batch(spark) > ARROW_ROWS
        stage[1](spark, docs, str(tmp_path))
        assert largest_batch(spark) == ARROW_ROWS
        spark.conf.set(ROWS, "700")
        corpus_pipeline.pack(spark, docs, str(tmp_path))
        assert largest_batch(spark) == 700
    finally:
        spark.conf.unset(ROWS)


def test_near_dedup_forgets_words_with_the_task():
    texts = pa.RecordBatch.from_pydict({"doc_id": [1], "text_hash": [1], "node": [1], "text": [PROSE[0]]})
    for step in (near_dedup._signatures(2), near_dedup._sets(2)):
        found = step(iter([texts]))
        next(found)
        assert near_dedup._hashes
        assert list(found) == []
        assert not near_dedup._hashes


def test_a_small_memory_gives_the_same_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, small = Encoder(path, "words"), Encoder(path, "words", remembered=5)
    for text in PROSE:
        assert small.encode(text.encode()) == whole.encode(text.encode())
        # A word with its full stop adds the word, too.
        assert len(small.plain) <= 6
