"""Spelling variants against comparing all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import LOWER, clashing, documents, rows

from hitledger.llm import variants
from hitledger.sources import scratch

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def counted(pairs):
    counts = Counter()
    for doc_id, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(pairs):
    words = counted(pairs)
    near = defaultdict(list)
    for a in words:
        near[a] = [b for b in words if abs(len(a) - len(b)) < 2 and one_edit(a, b)]
    form = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= 10 * words[word]:
                form[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, n, len(near[word]), form.get(word), words.get(form.get(word)), root))
    return sorted(out, key=repr)


def compare(spark, pairs):
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    assert rows(variants.spelling_variants(df), *COLUMNS) == plain(pairs)


def made_up(seed, letters, n_words=250, n_texts=80):
    """Words of few letters, and copies of them with edits at all places, runs included."""
    draw = random.Random(seed)
    words = ["".join(draw.choice(letters) for _ in range(draw.randrange(7, 11))) for _ in range(n_words)]
    for word in words[: n_words // 2]:
        at, c = draw.randrange(len(word) + 1), draw.choice(letters)
        words += [word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]]
    weights = [draw.choice([1, 1, 3, 30, 900]) for _ in words]
    return [(i, " ".join(draw.choices(words, weights, k=150))) for i in range(n_texts)]


@pytest.mark.parametrize("letters", ["ab", "abcdé", "abcdefghijklmnopÀß÷×"])
def test_made_up_words(spark, letters):
    compare(spark, made_up(len(letters), letters))


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_any_dictionary_and_length_of_lists(spark, letters, monkeypatch):
    """Rare and common grams, short and long lists, all refiled lists: the same result."""
    pairs = made_up(5, letters)
    for bound, most in ((1, 2), (10_000, 3), (3, 1), (40, 20_000)):
        monkeypatch.setattr(variants, "LEAST_BOUND", bound)
        words = spark.createDataFrame(list(counted(pairs).items()), "word string, n long")
        grams = variants.gram_dictionary(words)
        found = rows(variants.near_counts(variants.filed(words, grams), most), "word", "n_near")
        assert found == sorted(((w, n) for w, _, n, *_ in plain(pairs) if n), key=repr)


def test_long_words(spark):
    """Words beyond LONG_WORD, with equal characters in a row, and one of 100,000 characters."""
    base = "ab" * 150
    words = [base, base + "b", "a" + base, base[:77] + "x" + base[78:], base[:77] + base[78:], "z" * 300, "z" * 299]
    pairs = [(None, " ".join(words * 2)), (5, "y" * 100_000 + " " + "y" * 100_000)]
    compare(spark, pairs)


def test_ways_to_the_root(spark):
    """A word leads to its form's form; ties go to the smaller word."""
    text = " ".join(["bananas"] * 2 + ["bananaz"] * 20 + ["banana" + "zz"] * 200 + ["cananaz"] * 200 + ["canana"] * 9)
    compare(spark, [(1, text)])
    compare(spark, [(4, "lettersx " * 2 + "lettersa " * 20 + "lettersb " * 20)])


def test_odd_rows_and_empty_table(spark):
    docs = clashing(documents(spark))
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    found = variants.spelling_variants(docs)
    assert sorted(found.columns) == sorted(COLUMNS)
    assert rows(found, *COLUMNS) == plain(pairs)
    assert variants.spelling_variants(docs.where("false")).collect() == []


def test_counting_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(variants, "COUNTED", 5)
    monkeypatch.setattr(variants, "DROP_ONE_IN", 31)
    pairs = made_up(9, "abcdefgh", n_words=60, n_texts=9)
    runs = re.compile("[A-Za-zÀ-ÿ]{7,}")
    total = Counter()
    for doc_id, text in pairs:
        total.update(variants.document_words(doc_id, text.encode(), runs))
    assert {w: n for w, n in total.items() if n >= 2} == counted(pairs)


def test_working_folders_go_with_the_others(spark):
    """What operators write on the way is registered, so that `scratch.clear` removes it."""
    before = set(scratch._folders)
    variants.word_counts(documents(spark))
    made = [path for _, path in set(scratch._folders) - before]
    assert len(made) == 1 and spark.sparkContext.applicationId in made[0]
