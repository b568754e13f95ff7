"""Classifiers, the language model and the pipeline."""

import math
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
from helpers import SF_DIR, clashing, crc, documents, rows, white_words
from pyspark.sql import functions as F

import corpus_pipeline
from hitledger.llm import decontamination, language_id, lm_scoring, quality, queries
from hitledger.llm.common import saved

SF001 = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    found = queries.op2_quality(spark, SF001)
    assert found.count() == 1_000
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    held = found.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.collect())


def test_quality_of_odd_rows(spark):
    docs = clashing(documents(spark))
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (6, None)], "doc_id long, label int")
    for own in (labels, labels.limit(0)):
        scores = quality.scored(docs, quality.train(docs, own)).collect()
        assert len(scores) == docs.count()
        assert all(0 <= r.score <= 1 for r in scores)
    assert quality.scored(docs.limit(0), quality.train(docs, labels)).count() == 0


def test_trees_in_arrays_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    forest = quality.grow(x, y)
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.95
    bins = forest.binned(x[:20])
    for row, score in zip(bins, forest.scores(x[:20]), strict=True):
        total = forest.base
        for features, cuts, leaves in zip(forest.features, forest.cuts, forest.leaves, strict=True):
            node = 0
            while node < len(features):
                node = 2 * node + (2 if row[features[node]] > cuts[node] else 1)
            total += leaves[node - len(features)]
        assert math.isclose(score, 1 / (1 + math.exp(-total)))


def test_language_on_held_out_documents(spark):
    found = queries.op10_language_id(spark, SF001)
    truth = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    held = found.where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert found.count() == 1_000 and all(0 <= r.score <= 1 for r in found.collect())


def test_language_of_odd_rows(spark):
    docs = clashing(documents(spark))
    model = language_id.train(docs, F.lit(True))
    found = language_id.identified(docs, model)
    assert found.columns == [*docs.columns, "_language"]
    assert {r.language for r in found.collect()} == {r.language for r in docs.collect()}
    by_id = {r.doc_id: r._language for r in found.where("doc_id is not null").collect()}
    assert {i for i, x in by_id.items() if x.name == "und"} == {5, 6, 7, 11}
    assert by_id[5].score == 0 and by_id[1].name == "en"
    kept = language_id.accepted(docs, model)
    assert kept.columns == docs.columns and kept.where("lang is null").isEmpty()
    passed_on = [c for c in docs.columns if c != "lang"]
    wanted = docs.where("doc_id is null or doc_id not in (5, 6, 7, 11)").select(*passed_on)
    assert rows(kept.select(*passed_on)) == rows(wanted)
    none = language_id.train(docs.where("false"), F.lit(True))
    assert {r._language.name for r in language_id.identified(docs, none).collect()} == {"und"}
    assert language_id.identified(docs.limit(0), model).count() == 0


def test_copies_do_not_thin_the_language_sample(spark):
    """A text with very many copies leaves its language the full sample of others."""
    english = [(f"the cat number {i} sleeps near the warm stove while it rains", "en") for i in range(300)]
    french = [(f"le chat {i} dort dans la maison pendant que la pluie tombe", "fr") for i in range(300)]
    rows = spark.createDataFrame([*english, *french], "text string, lang string")
    copies = spark.range(60_000).select(F.lit("le chien dort").alias("text"), F.lit("fr").alias("lang"))
    docs = rows.union(copies)
    known = docs.select("lang", "text", F.xxhash64("text").alias("hash"))
    want = {}
    for lang in ("en", "fr"):
        hashes = known.where(F.col("lang") == lang).select("hash").distinct().orderBy("hash").collect()
        want[lang] = hashes[min(len(hashes), 40) - 1].hash
    assert language_id._least_hashes(known, 40) == want
    model = language_id.train(docs, F.lit(True), per_language=40)
    for text, lang in (*english[:20], *french[:20]):
        assert model.predict(text.encode())[0] == lang


def test_language_machines_are_trained_in_tasks(spark, monkeypatch):
    """The driver gets weights and deviations, no vector; the model is that of one sorted matrix."""
    stems = {"en": "the cat {} sleeps", "de": "die Katze {} liegt", "fr": "le chat {} dort", "xx": "kxq {} zzv"}
    texts = [(stem.format(i * 7919), lang) for lang, stem in stems.items() for i in range(300)]
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(5)
    frame, seen = type(docs), []
    collect = frame.collect

    def counted(df):
        seen.append(collect(df))
        return seen[-1]

    monkeypatch.setattr(frame, "collect", counted)
    model = language_id.train(docs, F.lit(True))
    monkeypatch.undo()
    binary = sum(len(v) for rows in seen for r in rows for v in r if isinstance(v, bytes | bytearray))
    assert binary <= 4 * 8 * (language_id.FEATURES + 1)
    vectors = sorted((n, language_id.frequencies(t.encode()).astype("<f4").tobytes()) for t, n in texts)
    x = np.stack([np.frombuffer(v, "<f4") for _, v in vectors]).astype(float)
    scale = 1 / (x.std(axis=0) + 1e-4) / np.sqrt(language_id.FEATURES)
    scaled = np.hstack([x * scale, np.ones((len(x), 1))])
    names = np.array([n for n, _ in vectors])
    families = np.array([language_id.family_of(n) for n in names.tolist()])
    assert model.families.names == ["germanic", "only xx", "romance"]
    assert {f: c.names for f, c in model.languages.items()} == {"germanic": ["de", "en"], "only xx": ["xx"], "romance": ["fr"]}
    for choice, labels in ((model.families, families), (model.languages["germanic"], names)):
        for k, (a, b) in enumerate(combinations(choice.names, 2)):
            own = (labels == a) | (labels == b)
            w = language_id.linear_svm(scaled[own], np.where(labels[own] == a, 1.0, -1.0))
            assert np.allclose(choice.weights[:, k], w[:-1] * scale, rtol=1e-9, atol=1e-12)
            assert math.isclose(choice.offsets[k], w[-1], rel_tol=1e-9)


def test_accepted_documents_carry_the_prediction(spark):
    model = language_id.train(documents(spark), F.lit(True))
    wrong = documents(spark).withColumn("lang", F.lit("xx"))
    kept = language_id.accepted(wrong, model).where("doc_id is not null").collect()
    assert {r.doc_id: r.lang for r in kept} == {
        r.doc_id: model.predict(r.text.encode())[0] for r in kept
    }
    assert kept and all(r.lang != "xx" for r in kept)


def test_family_comes_first():
    assert language_id.family_of("en") == language_id.family_of("de-AT") == "germanic"
    assert language_id.family_of("xx") == "only xx"


def lm_expected(texts, trained):
    counts = Counter(w for t, own in zip(texts, trained, strict=True) if own for w in [*white_words(t), " "])
    n, v = sum(counts.values()), len(counts)
    out = []
    for t in texts:
        words = [*white_words(t), " "]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out.append((len(words), sum(counts[w] > 0 for w in words), n, base))
    return out


def test_lm_base_scores_by_brute_force(spark):
    found = queries.op6_lm_scoring(spark, SF_DIR).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    trained = [crc(r.doc_id, 7) != 2 for r in docs]
    for r, own, (n, known, total, base) in zip(found, trained, lm_expected([d.text for d in docs], trained), strict=True):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not own, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("order", [2, 3])
def test_lm_of_odd_rows(spark, order):
    docs = clashing(documents(spark))
    found = lm_scoring.scores(docs, F.col("doc_id") > 2, order=order)
    assert found.count() == docs.count()
    texts = [r.text for r in docs.collect()]
    trained = [r.doc_id is not None and r.doc_id > 2 for r in docs.collect()]
    want = sorted((n, known, total, round(base, 6)) for n, known, total, base in lm_expected(texts, trained))
    got = [(r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found.collect()]
    assert sorted(got) == want
    assert lm_scoring.scores(docs.limit(0), F.lit(True)).count() == 0
    untrained = lm_scoring.scores(docs, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in untrained} == {(0, 0, 0.0, 0.0)}


def test_lm_scores_are_asked_for_in_parts(spark, monkeypatch):
    """The questions of some documents only lie in a shuffle at a time; no document is lost or twice."""
    parts = []

    def kept(df, name):
        parts.append(saved(df, name))
        return parts[-1]

    monkeypatch.setattr(lm_scoring, "saved", kept, raising=False)
    rows = [(i, f"a b c w{i} w{i % 7} a b") for i in range(300)] + [(None, "a b"), (None, None), (5, "a b c"), (5, "a b c")]
    found = lm_scoring.scores(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True))
    ids = [r.doc_id for r in found.collect()]
    assert sorted(ids, key=str) == sorted((i for i, _ in rows), key=str)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == len(rows) and max(sizes) < 0.7 * len(rows)
    assert "FlatMapCoGroups" not in found._jdf.queryExecution().toString()


def test_automaton_is_a_distribution(spark):
    """Over all words and the unknown one, each state's probabilities add up to 1."""
    docs = spark.createDataFrame(
        [("a b a b c a b a b c",), ("a b c c b a a b c a b",), ("b a b c a b c",)] * 4, "text string"
    )
    a, _, _ = lm_scoring.train(docs, F.lit(True))
    n = len(a.words)
    ids = np.arange(1, n + 1)
    unigram = a.unigram(a.train)
    assert math.isclose(unigram.sum() + a.unknown, 1)

    def after(k, state, shorter, unknown):
        key = (np.uint64(state) << np.uint64(32)) | ids.astype(np.uint64)
        arc = lm_scoring._found(a.arcs[k], key)
        backed = 10 ** a.failures[k][state]
        return np.where(arc > 0, 10 ** a.arc_logs[k][arc], backed * shorter), backed * unknown

    for word in range(1, n + 2):
        p, unknown = after(0, word, unigram, a.unknown)
        if word <= n and a.train[word - 1] != np.bincount(
            (a.arcs[0] >> np.uint64(32)).astype(int), a.arc_counts[0], n + 2
        )[word]:
            continue  # the end token, which nothing follows
        assert math.isclose(p.sum() + unknown, 1)
    for state, arc in enumerate(a.arcs[0], 1):
        last = int(arc & np.uint64(0xFFFFFFFF))
        p, unknown = after(1, state, *after(0, last, unigram, a.unknown))
        assert math.isclose(p.sum() + unknown, 1)


@pytest.mark.parametrize("states, filter_bits", [(20_000, 30), (500, 30), (500, 0)])
@pytest.mark.parametrize("order", [2, 3])
def test_lm_scores_do_not_depend_on_what_is_broadcast(spark, monkeypatch, order, states, filter_bits):
    """A small automaton stands for a large corpus: n-grams it lacks are still scored."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")

    def found():
        out = lm_scoring.scores(docs, F.col("doc_id") % 7 != 2, order=order).orderBy("doc_id").collect()
        return np.array([tuple(r) for r in out], float)

    whole = found()
    monkeypatch.setattr(lm_scoring, "STATES", states)
    monkeypatch.setattr(lm_scoring, "FILTER_BITS", filter_bits)
    assert np.allclose(found(), whole, rtol=1e-9, atol=1e-9)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.saved(stage(spark, docs, SF_DIR), "test")
        assert after.columns == docs.columns and 0.7 * before < after.count() <= docs.count(), name
        docs = after
    assert not decontamination.contamination_report(docs, items).where("contaminated").count()
    packed = corpus_pipeline.pack(spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_pipeline_of_odd_rows(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() > 0
    empty = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_DIR)
    assert empty.count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    expected = duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(expected.columns)
    actual = queries.QUERIES[name](spark, SF001).select(*columns).collect()
    assert sorted(map(repr, map(tuple, actual))) == sorted(map(repr, expected.select(*columns).fetchall()))


def test_contract_columns(spark):
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
