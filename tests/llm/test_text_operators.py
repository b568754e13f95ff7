"""Deduplication and decontamination against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from helpers import LONG, PROSE, SF_DIR, clashing, documents, linked, plain_words, rows, shingle_sets
from pyspark.sql import functions as F

from hitledger.llm import decontamination, exact_dedup, near_dedup
from hitledger.llm.components import components

ITEMS = [
    (1, " ".join(PROSE[1].split()[:12])),
    (2, " ".join(PROSE[1].split()[2:14])),
    (2, "unrelated words of a second item with the same number as that other one"),
    (3, "lazy dog"),
    (4, "LAZY, dog!"),
    (5, None),
    (6, ""),
    (7, "..."),
    (None, "nobody s words"),
]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_report(spark):
    docs = documents(spark)
    expected, groups = [], defaultdict(list)
    for r in docs.collect():
        groups[normal(r.text)].append(r)
    for text, own in groups.items():
        first = min(own, key=lambda r: (-len(r.text or ""), r.doc_id is not None, r.doc_id or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected += [(r.doc_id, first.doc_id, len(own), sha) for r in own]
    found = exact_dedup.dedup_report(clashing(docs))
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    assert rows(found, *columns) == sorted(expected, key=repr)
    kept = found.where("kept").groupBy("text_sha256").count().collect()
    assert {r["count"] for r in kept} == {1} and len(kept) == len(groups)


def test_exact_dedup_keeps_whole_rows(spark):
    docs = clashing(documents(spark))
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(r.text) for r in docs.collect()})
    assert {r.doc_id for r in kept.collect()} >= {1, 3, 4, 9, 14}


def test_filter_only_saves_shuffles(spark, monkeypatch):
    """With a filter so small that every row is a candidate the result is the same."""
    docs = documents(spark)
    expected = rows(exact_dedup.dedup_report(docs).drop("kept"))
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 2)
    assert rows(exact_dedup.dedup_report(docs).drop("kept")) == expected


def test_unique_rows_are_no_candidates(spark):
    docs = spark.range(2_000).selectExpr("id AS doc_id", "if(id < 10, 'same', 'text ' || id) AS text")
    digests = exact_dedup.digests(docs)
    bits = exact_dedup._filter_bits(2_000)
    tested = exact_dedup.with_candidates(digests, exact_dedup.repeated_slots(digests, bits), bits)
    assert 10 <= tested.where("_maybe").count() < 60
    assert tested.where("_id < 10 and not _maybe").isEmpty()


@pytest.mark.parametrize("size", [1, 2, 5])
def test_near_duplicates_by_brute_force(spark, size):
    rng = random.Random(size)
    texts = []
    for _ in range(40):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(1, 6)):
            copy = [w if rng.random() > 0.03 else f"x{rng.randrange(99)}" for w in base]
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near_dedup.near_duplicates(docs, size=size)
    sets = shingle_sets(texts, size)
    first = linked(sets, 80)
    expected = [(i, len(sets[i]), first[i], first[i] == i) for i in range(len(texts))]
    assert rows(found, "doc_id", "n_shingles", "component_id", "kept") == sorted(expected, key=repr)


def test_near_duplicates_of_odd_rows(spark):
    docs = documents(spark)
    found = near_dedup.near_duplicates(clashing(docs), size=2)
    assert found.count() == docs.count()
    got = {r.doc_id: r for r in found.where("doc_id is not null").collect()}
    assert [got[i].component_id for i in (1, 2, 4, 5, 6, 7, 8, 9)] == [1, 1, 4, 5, 6, 7, 8, 8]
    assert [got[i].n_shingles for i in (5, 6, 7, 8)] == [0, 0, 0, 1]
    assert got[12].component_id == -3 and not got[12].kept
    none = {(r.n_shingles > 0, r.component_id) for r in found.where("doc_id is null").collect()}
    assert none == {(True, 10), (True, None)}


def test_near_dedup_filter(spark):
    docs = clashing(documents(spark))
    kept = near_dedup.near_deduplicated(docs, size=2)
    assert kept.columns == docs.columns
    # 3 shares 16 of 19 shingles with 1, 14 has all of 4's and one more.
    assert {r.doc_id for r in kept.collect()} == {1, 4, 5, 6, 7, 8, 10, 11, None, -3, 13}


def test_a_large_bucket_loses_no_link(spark, monkeypatch):
    """Without stars, pairs across blocks alone find all links."""
    monkeypatch.setattr(near_dedup, "STAR_TURNS", 0)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near_dedup.near_duplicates(docs, size=1)
    assert {r.component_id for r in found.collect()} == {0}


def test_components_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    hub = [(500, i) for i in range(501, 560)] + [(7, 7)]
    found = components(spark.createDataFrame(path + hub, "a long, b long"))
    assert {(r.node, r.component) for r in found.collect()} == {
        *((i, 100) for i in range(100, 141)),
        *((i, 500) for i in range(500, 560)),
    }


def brute_hits(items, text, window=10):
    words, hit, found = plain_words(text), set(), set()
    for item, item_text in items:
        own = plain_words(item_text)
        sizes = [own] if len(own) < window else [own[i : i + window] for i in range(len(own) - window + 1)]
        for w in sizes if own else []:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(str(item) if item is not None else "")
    return words, hit, found


@pytest.mark.parametrize("block", [200_000, 5])
def test_contamination_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    docs = documents(spark).where(F.length("text") < 10_000)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = []
    for r in docs.collect():
        words, hit, found = brute_hits(ITEMS, r.text)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected.append((r.doc_id, len(words), len(hit), len(found), sha, bool(hit)))
    report = decontamination.contamination_report(clashing(docs), items)
    assert rows(report) == sorted(expected, key=repr)


def test_contamination_of_random_words(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(i, text(rng.randrange(0, 14))) for i in range(12)]
    automaton = decontamination.SuffixAutomaton.of([(str(i), [w.encode() for w in plain_words(t)]) for i, t in items], 6)
    for _ in range(300):
        t = text(rng.randrange(0, 40))
        spans, found, _ = automaton.match([w.encode() for w in plain_words(t)])
        _, hit, expected = brute_hits(items, t, window=6)
        assert ({i for a, b in spans for i in range(a, b)}, found) == (hit, expected)


@pytest.mark.parametrize("block", [200_000, 5])
def test_decontamination_cuts_and_drops(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    mixed_in = (99, "Before it all. " + PROSE[1] + " " + " ".join(f"after{i}" for i in range(40)), "en", "a", 0)
    docs = clashing(documents(spark).union(spark.createDataFrame([mixed_in], documents(spark).schema)))
    clean = decontamination.decontaminated(docs, items)
    assert clean.columns == docs.columns
    left = {r.doc_id: r for r in clean.collect()}
    assert 4 not in left and 14 not in left
    assert left[99].text.startswith("Before it all. ") and "after39" in left[99].text
    assert left[99].n_chars == len(left[99].text)
    assert left[-3].text == LONG and left[5].text is None and left[6].text == ""
    assert not decontamination.contamination_report(clean, items).where("contaminated").count()


def test_bit_map_lets_every_wanted_row_through(spark):
    all_ = spark.range(20_000).select(
        F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), (F.col("id") % 97).alias("text_hash")
    )
    wanted = all_.where("doc_id is null or doc_id % 50 = 0")
    sha = F.xxhash64("doc_id", "text_hash")
    found = near_dedup._maybe_among(all_.withColumn("_sha", sha), wanted).where("_maybe").drop("_sha", "_maybe")
    assert found.columns == ["doc_id", "text_hash"]
    assert wanted.exceptAll(found).isEmpty()
    assert found.count() < 1.2 * wanted.count()
    nothing = near_dedup._maybe_among(all_.withColumn("_sha", sha), wanted.limit(0))
    assert nothing.where("_maybe").isEmpty() and nothing.count() == 20_000


def plain_cut(items, text, max_coverage, window):
    """None for a document that goes, else its text without the items' windows."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.ASCII)
    first = True
    while True:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        places = [m.span() for m in pattern.finditer(low)]
        words, hit, _ = brute_hits(items, text, window)
        if first and len(hit) > max_coverage * len(words):
            return None
        first = False
        if not hit:
            return text
        runs = [(a, run_end(hit, a)) for a in sorted(hit) if a - 1 not in hit]
        for a, b in reversed(runs):
            text = text[: places[a][0]] + text[places[b][1] :]


def run_end(hit, a):
    while a + 1 in hit:
        a += 1
    return a


@pytest.mark.parametrize("block", [200_000, 5])
def test_decontamination_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice(["a", "B", "c"]) for _ in range(n))
    items = [(i, text(rng.randrange(4, 9))) for i in range(6)] + [(7, None), (8, ""), (9, "- -")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(120)] + [(200, None), (201, "")]
    item_rows = spark.createDataFrame(items, "item_id long, text string")
    made = spark.createDataFrame(docs, "doc_id long, text string")
    for coverage in (0.3, 0.9):
        clean = decontamination.decontaminated(made, item_rows, coverage, window=5)
        expected = {
            d: t if t is None else plain_cut([x for x in items if x[1]], t, coverage, 5) for d, t in docs
        }
        expected = {d: t for d, t in expected.items() if t is not None or d == 200}
        assert {r.doc_id: r.text for r in clean.collect()} == expected


def test_items_of_one_text_share_an_automaton(spark):
    passage = " ".join(f"word{i}" for i in range(12))
    items = spark.range(100_000).select(F.col("id").alias("item_id"), F.lit(passage).alias("text"))
    (path,) = decontamination.automata(items, "item_id", "text", 10)
    (block,) = decontamination._loaded([path])
    assert len(block.automaton.lengths) == 13 and len(block.ids) == 1 and len(block.ids[0]) == 100_000
    docs = spark.createDataFrame([(1, "before " + passage), (2, "clean")], "doc_id long, text string")
    report = {r.doc_id: r for r in decontamination.contamination_report(docs, items).collect()}
    assert report[1].n_items == 100_000 and report[1].n_hit == 12
    assert report[2].n_items == 0 and not report[2].contaminated


def test_empty_tables(spark):
    docs = documents(spark).limit(0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert exact_dedup.dedup_report(docs).count() == 0
    assert exact_dedup.deduplicated(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0
    assert near_dedup.near_deduplicated(docs).count() == 0
    assert decontamination.contamination_report(docs, items).count() == 0
    assert decontamination.decontaminated(docs, items).count() == 0
    whole = documents(spark)
    report = decontamination.contamination_report(whole, items.limit(0))
    assert report.where("contaminated").count() == 0 and report.count() == whole.count()


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    sets = shingle_sets(texts, 2)
    first = linked(sets, 80)
    found = near_dedup.near_duplicates(docs).orderBy("doc_id").collect()
    assert [r.component_id for r in found] == first
