"""Spelling variants: words one edit apart, found by an index of variable-length grams.

Words are counted over whole texts. Two different words are near if one inserted, deleted or
replaced character makes them equal. The method:

1. *Gram dictionary.* Counted over the padded words, every piece of 2 to LONGEST characters that
   more than a bound of words hold is common. The bound grows with the vocabulary so that the
   dictionary of common grams stays below DICTIONARY entries for each length, whatever the corpus;
   it is the only thing broadcast.
2. *Decomposition.* At every place of a word starts one gram: the shortest piece that is not
   common any more, or LONGEST characters. A gram depends on its own characters only.
3. *Affected grams.* An edit at one place of a word affects the grams that hold this place, at
   most LONGEST - 1 before it and itself; the grams left of them keep their distance from the
   start, those right of them from the end. For each place, that bounds which lists can be merged.
4. *Merged lists.* Near words share all grams that their edit leaves alone. For each place the
   lists of the rarest of these are merged until few words are expected to stay, and what is
   merged (the grams, their distances, the length without the edited character) is the key under
   which the word is filed for this place. Places with the same key are filed once; equal keys
   meet in one shuffle.
5. *Verification.* Words under one key agree on most characters. They are near if, the character
   at a filed place taken out, the same text is left: an exact test by a hash table, linear in the
   list, which never compares all pairs of one. A pair is met at one place only (for a run of
   equal characters, its first), so nothing is counted twice.

Each word's near words are counted and the best one kept per list, and these partial results are
added up in a second shuffle.

Defined results: missing and empty texts have no words; words of any length are taken whole; ties
of the most frequent near word go to the smallest in code-point order; repeated rows count each;
an empty table gives an empty result; columns other than those named are not looked at.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import ready, saved, text_bytes

RUN = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 7, 2
# One in so many (document, run) pairs loses a character.
DROP_ONE_IN = 31
# A near word is the form of a word if it is so many times as frequent.
TIMES = 10

START, END = "\x02", "\x03"
SHORTEST, LONGEST = 2, 4
# Entries of the dictionary for each length of gram, and the least bound of a common gram.
DICTIONARY = 200_000
LEAST_BOUND = 30
# Words a worker counts before it passes the counts on.
COUNTED = 300_000
# From here on words are compared by hashes of what is left instead of slices.
LONG_WORD = 200


# Words of documents


def document_words(doc_id: object, text: bytes, runs: re.Pattern[str]) -> Counter[str]:
    """The words of a text with their counts, one character dropped where the draw says so."""
    # Lower case of bytes changes A-Z only.
    found = Counter(runs.findall(text.lower().decode(errors="replace")))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter[str] = Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), start)
        if h % DROP_ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        words[run] += n
    return words


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = re.compile(f"[{RUN}]{{{LEAST_LENGTH},}}")
    counts: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            counts.update(document_words(doc_id, text, runs))
            if len(counts) >= COUNTED:
                yield _batch(word=list(counts), n=list(counts.values()))
                counts.clear()
    if counts:
        yield _batch(word=list(counts), n=list(counts.values()))


def _batch(**columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns word and n: the distinct words that occur often enough, written down."""
    ready(docs.sparkSession)
    parts = docs.select(key, text).mapInArrow(_counted, "word string, n long")
    counted = parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    return saved(counted, "words")


def _dealt_out(words: DataFrame) -> DataFrame:
    """The words over as many tasks as a shuffle has, since each costs far more than its bytes."""
    return words.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# The dictionary


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            padded = f"{START}{word}{END}"
            counts.update(
                {padded[i : i + k] for k in range(SHORTEST, LONGEST + 1) for i in range(len(padded) - k + 1)}
            )
            if len(counts) >= COUNTED:
                yield _batch(gram=list(counts), n=list(counts.values()))
                counts.clear()
    if counts:
        yield _batch(gram=list(counts), n=list(counts.values()))


class Grams:
    """The common grams, and what they make of a word.

    At most characters / bound grams of each length have more than `bound` words, and the
    bound is at least characters / DICTIONARY.
    """

    def __init__(self, common: dict[str, int], bound: int, words: int):
        self.common, self.bound, self.words = common, bound, words

    def ends(self, padded: str) -> tuple[list[int], list[int]]:
        """For each place the end of the gram that starts there, and how many words hold it."""
        ends, counts = [], []
        size, common = len(padded), self.common
        for p in range(size - SHORTEST + 1):
            end, held = p + SHORTEST, 0
            while True:
                held = common.get(padded[p:end], 0)
                if not held or end == size or end - p == LONGEST:
                    break
                end += 1
            ends.append(end)
            counts.append(held or self.bound)
        return ends, counts

    def keys(self, word: str) -> tuple[dict[int, list[int]], dict[int, list[int]]]:
        """Merged lists of a word by key: places to replace or delete, and places to insert.

        Both words of a near pair choose among the same grams by the same ranks, so they choose
        alike: grams left of the edit are told by their start, the others by their distance from
        the end. The ends of grams never fall from place to place, so those left of an edit are
        the first few.
        """
        padded = f"{START}{word}{END}"
        ends, counts = self.ends(padded)
        size, n, words, bound = len(padded), len(ends), self.words, self.bound
        # A gram that half of the words hold hardly narrows a list.
        ranked = [p for p in sorted(range(n), key=counts.__getitem__) if 2 * counts[p] <= words]
        shares = [c / words for c in counts]
        filed: tuple[dict[int, list[int]], dict[int, list[int]]] = ({}, {})
        for taken in (1, 0):
            keys: dict[tuple, int] = {}
            places, n_left = filed[1 - taken], 0
            for left in range(1, size - taken):
                right = left + taken
                while n_left < n and ends[n_left] <= left:
                    n_left += 1
                expected, chosen = float(words), []
                for p in ranked:
                    if expected <= bound:
                        break
                    if p < n_left or p >= right:
                        end = ends[p]
                        for q in chosen:
                            if end > q and p < ends[q]:
                                break
                        else:
                            chosen.append(p)
                            expected *= shares[p]
                if expected <= bound:
                    chosen.sort()
                    name = (bisect_left(chosen, left), *chosen)
                else:
                    # Even so too many words may stay: all lists are merged, that is, all text
                    # left of the affected grams and all right of them.
                    name = (-1, ends[n_left - 1] if n_left else 0, right)
                key = keys.get(name)
                if key is None:
                    if name[0] < 0:
                        parts = [padded[: name[1]], padded[right:]]
                    else:
                        parts = [
                            f"{p}<{padded[p : ends[p]]}" if p < left else f"{size - p}>{padded[p : ends[p]]}"
                            for p in chosen
                        ]
                    text = "|".join([str(size - taken), str(name[0] < 0), *parts])
                    key = keys[name] = _signed(xxhash.xxh3_64_intdigest(text.encode()))
                    places.setdefault(key, [])
                places[key].append(left - 1)
        return filed


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number


def gram_dictionary(words: DataFrame) -> Grams:
    sizes = words.agg(F.count("*").alias("words"), F.sum(F.length("word") + 2).alias("characters")).first()
    bound = max(LEAST_BOUND, -(-(sizes.characters or 0) // DICTIONARY))
    parts = _dealt_out(words.select("word")).mapInArrow(_gram_counts, "gram string, n long")
    counted = parts.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > bound)
    return Grams({r.gram: r.n for r in counted.toLocalIterator()}, bound, sizes.words)


# Lists

# What a filed place of a word stands for; lists that grow too long are filed anew by one of them.
REPLACE, DELETE, INSERT = 1, 2, 4
LISTED = "key long, word string, n long, kind int, places array<int>"
# Words of a list that are held at once.
LIST_WORDS = 20_000


def filed(words: DataFrame, grams: Grams) -> DataFrame:
    """Each word under the keys of its merged lists."""
    shared = words.sparkSession.sparkContext.broadcast((grams.common, grams.bound, grams.words))

    def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grams(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = []
                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    replaced, inserted = own.keys(word)
                    rows += [(key, word, n, REPLACE | DELETE, places) for key, places in replaced.items()]
                    rows += [(key, word, n, INSERT, []) for key in inserted]
                yield _listed(rows)

    return _dealt_out(words.select("word", "n")).mapInArrow(file, LISTED)


def _listed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return pa.record_batch(arrays, ["key", "word", "n", "kind", "places"])


def _left(word: str, at: int) -> str | bytes:
    """The word without the character at a place; of a long word, a hash of that."""
    rest = word[:at] + word[at + 1 :]
    return rest if len(rest) < LONG_WORD else xxhash.xxh3_128_digest(rest.encode())


def _whole(word: str) -> str | bytes:
    return word if len(word) < LONG_WORD else xxhash.xxh3_128_digest(word.encode())


def _firsts(word: str, places: list[int]) -> list[int]:
    """Of a run of equal characters, only the first is deleted."""
    return [at for at in places if at == 0 or word[at - 1] != word[at]]


class Found:
    """Near words of one list: their number and the most frequent, for each word."""

    def __init__(self) -> None:
        self.near: Counter[str] = Counter()
        self.best: dict[str, tuple[int, str]] = {}

    def add(self, word: str, n_near: int, best: tuple[int, str]) -> None:
        """`best` is (-n, word), so that the least is the one wanted."""
        self.near[word] += n_near
        self.best[word] = min(self.best.get(word, best), best)


def verified(rows: list[tuple]) -> Found:
    """The near words among rows (word, n, kind, places) of one list."""
    found = Found()
    alike: dict[tuple, list[tuple[int, str]]] = defaultdict(list)
    whole = {_whole(word): (-n, word) for word, n, kind, _ in rows if kind & INSERT}
    for word, n, kind, places in rows:
        if kind & REPLACE:
            for at in places:
                alike[at, _left(word, at)].append((-n, word))
        if kind & DELETE and whole:
            for at in _firsts(word, places):
                other = whole.get(_left(word, at))
                if other is not None:
                    found.add(word, 1, other)
                    found.add(other[1], 1, (-n, word))
    for group in alike.values():
        if len(group) > 1:
            first, second = sorted(group)[:2]
            for own in group:
                found.add(own[1], len(group) - 1, second if own == first else first)
    return found


def _filed_anew(rows: list[tuple]) -> Iterator[tuple]:
    """Rows of a list that is too long, under one key for each text that may be left."""
    key = lambda *of: _signed(xxhash.xxh3_64_intdigest(repr(of).encode()))
    for word, n, kind, places in rows:
        if kind & REPLACE:
            for at in places:
                yield key(at, _left(word, at)), word, n, REPLACE, [at]
        if kind & DELETE:
            for at in _firsts(word, places):
                yield key(_left(word, at)), word, n, DELETE, [at]
        if kind & INSERT:
            yield key(_whole(word)), word, n, INSERT, []


RESULT = "word string, n_near long, best_n long, best string, again struct<key:bigint,n:bigint,kind:int,places:array<int>>"


def _results(words: list, near: list, best: list, again: list) -> pa.RecordBatch:
    struct = pa.struct([("key", pa.int64()), ("n", pa.int64()), ("kind", pa.int32()), ("places", pa.list_(pa.int32()))])
    return pa.record_batch(
        [
            pa.array(words, pa.string()),
            pa.array(near, pa.int64()),
            pa.array([None if b is None else -b[0] for b in best], pa.int64()),
            pa.array([None if b is None else b[1] for b in best], pa.string()),
            pa.array(again, struct),
        ],
        ["word", "n_near", "best_n", "best", "again"],
    )


def _in_company(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows sorted by key without those that no neighbour shares the key of.

    The first and the last row stay, as their list may go on in another batch.
    """
    keys = batch.column(0).to_numpy()
    same = keys[1:] == keys[:-1]
    return batch.filter(pa.array(np.concatenate(([True], same)) | np.concatenate((same, [True])))) if len(keys) else batch


def _lists(most: int | None):
    """Partial results of the lists in rows sorted by key; of longer ones than `most`, rows anew."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, near, best, again = [], [], [], []
        current, rows, spilled = None, [], False

        def again_filed() -> None:
            for key, word, n, kind, places in _filed_anew(rows):
                words.append(word)
                near.append(None)
                best.append(None)
                again.append({"key": key, "n": n, "kind": kind, "places": places})
            rows.clear()

        def ended() -> None:
            if spilled:
                again_filed()
            elif len(rows) > 1:
                found = verified(rows)
                words.extend(found.near)
                near.extend(found.near.values())
                best.extend(found.best[w] for w in found.near)
                again.extend([None] * len(found.near))
            rows.clear()

        for batch in batches:
            for key, *row in zip(*[c.to_pylist() for c in _in_company(batch).columns], strict=True):
                if key != current:
                    ended()
                    current, spilled = key, False
                rows.append(row)
                if most is not None and len(rows) >= most:
                    spilled = True
                    again_filed()
                if len(words) >= 50_000:
                    yield _results(words, near, best, again)
                    words, near, best, again = [], [], [], []
        ended()
        yield _results(words, near, best, again)

    return run


def near_counts(listed: DataFrame, most: int = LIST_WORDS) -> DataFrame:
    """Columns word, n_near, form_n, form: every word that has a near one, with the best of them.

    Lists of more than `most` rows are filed anew under what is left of each word, which at most
    the alphabet's number of words share at a place.
    """
    ordered = lambda df: df.repartition("key").sortWithinPartitions("key")
    first = saved(ordered(listed).mapInArrow(_lists(most), RESULT), "near-words")
    rest = first.where("again is not null").select(
        "again.key", "word", "again.n", "again.kind", "again.places"
    )
    second = ordered(rest).mapInArrow(_lists(None), RESULT)
    least = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    return (
        first.where("again is null")
        .unionAll(second)
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), least)
        .select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))
    )


# Forms


def roots(forms: DataFrame, most: int) -> DataFrame:
    """Columns word and root: where the forms of a word lead in the end.

    A form is TIMES as frequent as its word, so the longest way has as many steps as the
    greatest count has digits to that base; each round doubles the steps that are known.
    """
    steps, known = 0, 1
    while LEAST_COUNT * TIMES ** (steps + 1) <= most:
        steps += 1
    found = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while known < steps:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = found.join(ahead, "root", "left")
        found = saved(joined.select("word", F.coalesce("further", "root").alias("root")), "roots")
        known *= 2
    return found


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every word of the documents with its near words, form and root.

    Columns: word, n, n_near, form and form_n (null without a form), root.
    """
    words = word_counts(docs, key, text)
    grams = gram_dictionary(words)
    near = near_counts(filed(words, grams))
    is_form = F.col("best_n") >= TIMES * F.col("n")
    grouped = saved(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "word-forms",
    )
    most = words.agg(F.max("n")).first()[0] or 0
    ends = roots(grouped.where("form is not null"), most)
    return grouped.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
