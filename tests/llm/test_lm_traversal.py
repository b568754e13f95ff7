"""The language model against a plain backoff automaton, walked from left to right."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hitledger.llm import lm_scoring
from tests.llm.helpers import SF_DIR, clashing, crc, documents, white_words

BEGIN, END = "<begin>", "<end>"


class Plain:
    """States are tuples of words; an arc's word leads on, a failure drops the first word."""

    def __init__(self, texts, order):
        texts = [[*white_words(t), END] for t in texts]
        words = Counter(w for t in texts for w in t)
        n, ones, twos = sum(words.values()), *(sum(c == k for c in words.values()) for k in (1, 2))
        discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        self.order, self.unknown = order, discount * len(words) / n if n else 1.0
        self.arcs = {(w,): math.log10((c - discount) / n) for w, c in words.items()}
        self.failures, seen = {}, {(w,): c for w, c in words.items()} | {(BEGIN,): len(texts)}
        for size in range(2, order + 1):
            grams = Counter(
                tuple(t[i : i + size]) for t in ([BEGIN, *t] for t in texts) for i in range(len(t) - size + 1)
            )
            grams = {g: c for g, c in grams.items() if c >= lm_scoring.LEAST_COUNT}
            taken = defaultdict(float)
            for g, c in grams.items():
                taken[g[:-1]] += c - lm_scoring.DISCOUNT
            left = {s: 1 - taken[s] / seen[s] for s in taken}
            self.failures |= {s: math.log10(max(x, 1e-12)) for s, x in left.items()}
            for g, c in grams.items():
                own = (c - lm_scoring.DISCOUNT) / seen[g[:-1]]
                self.arcs[g] = math.log10(own + left[g[:-1]] * 10 ** self.arcs[g[1:]])
            seen = grams

    def score(self, text):
        total, state = 0.0, (BEGIN,)
        for word in [*white_words(text), END]:
            while (*state, word) not in self.arcs and state:
                total += self.failures.get(state, 0.0)
                state = state[1:]
            total += self.arcs.get((*state, word), math.log10(self.unknown))
            state = (*state, word)[1 - self.order :]
            while state and state not in self.arcs and len(state) > 1:
                state = state[1:]
        return total


def compare(docs, order):
    found = lm_scoring.scores(docs, F.col("trained"), order=order).collect()
    rows = docs.select("text", "trained").collect()
    plain = Plain([r.text for r in rows if r.trained], order)
    want = sorted(plain.score(r.text) for r in rows)
    assert np.allclose(sorted(r.score for r in found), want, rtol=1e-9, atol=1e-9)
    return found, plain


@pytest.mark.parametrize("order", [2, 3])
def test_scores_are_those_of_a_traversal(spark, order):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    held_out = [i for i in ids if crc(i, 7) == 2]
    found, plain = compare(docs.withColumn("trained", ~F.col("doc_id").isin(held_out)), order)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        assert math.isclose(r.score, plain.score(texts[r.doc_id]), rel_tol=1e-9)


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("states", [4_000_000, 3])
def test_scores_of_odd_rows(spark, monkeypatch, order, states):
    monkeypatch.setattr(lm_scoring, "STATES", states)
    docs = clashing(documents(spark)).withColumn("trained", F.coalesce(F.col("doc_id") > 2, F.lit(False)))
    compare(docs, order)


def test_tokens_of_pieces(monkeypatch):
    """Words, rows and pieces begin and end anywhere; words may be longer than a piece."""
    texts = ["", None, "Ab cD\tef", "a" * 50, "x", " ", "b" * 17 + "\n" + "ÄB" * 9, "y z", "", "q"]

    def tokens(values, piece):
        monkeypatch.setattr(lm_scoring, "PIECE", piece)
        column = pa.array([*["cut off"], *values], pa.string()).slice(1)
        out = []
        for _, hashes, starts in lm_scoring._hashed(column):
            out += [hashes[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)]
        return out

    whole = tokens(texts, 1 << 20)
    for piece in range(1, 40):
        assert tokens(texts, piece) == whole
    words = {w for t in texts for w in white_words(t)}
    assert len({h for row in whole for h in row}) == len(words) + 1
    for text, row in zip(texts, whole, strict=True):
        assert row == [*(tokens([w], 1 << 20)[0][0] for w in white_words(text)), int(lm_scoring.END[0])]
