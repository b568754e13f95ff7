"""Benchmark decontamination with a generalised suffix automaton over words.

The items of a benchmark go into one automaton of all their word sequences. The
words of each document are streamed through it; the automaton's state is the longest
stretch of words, ending here, that occurs in some item. Wherever that stretch is at
least a window long, its words are hit, and the state names the items.

Items of equal text are one sequence. A benchmark of more than a block of words gets
several automata, each built by a task and written to the shared folder; only the list
of files reaches the driver. Documents pass by a few automata at a time.

Words are runs of letters, digits and characters beyond ASCII, with A-Z in lower
case. A window is `window` consecutive words of an item; an item of fewer words (but
not none) is one window as a whole. A missing text has no words; an item without
words has no window; items of equal text are each reported, and a missing id as the
empty one; a repeated item counts once. With an empty benchmark nothing is hit.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import forget_words, give_back, saved, shared_folder, text_bytes, with_free_name

WINDOW = 10
# Words of items in one automaton: at most twice as many states, some 100 MB per worker. Only
# a single text of more words makes a larger one.
BLOCK_WORDS = 200_000
# Automata that one pass over the documents carries along.
BLOCKS_PER_PASS = 2

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_WORDS = bytes(
    c if c in _KEEP else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


@dataclass
class SuffixAutomaton:
    """All stretches of words of the items, with the items of each window.

    `arcs` maps state * n_words + word to the next state; `links` lead to the longest
    proper suffix that is a state of its own, `lengths` holds the longest stretch.
    """

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    arcs: dict[int, int] = field(default_factory=dict)
    links: list[int] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    window_items: dict[int, list[str]] = field(default_factory=dict)
    window_state: list[int] = field(default_factory=list)
    short_items: dict[int, list[tuple[int, list[str]]]] = field(default_factory=dict)
    pairs: np.ndarray | None = None
    shortest: int = 0

    @classmethod
    def of(cls, items: list[tuple[str, list[bytes]]], window: int) -> SuffixAutomaton:
        """From (item id, words); the ids are texts."""
        made = cls(window)
        for _, words in items:
            for word in words:
                made.vocabulary.setdefault(word, len(made.vocabulary))
        n = len(made.vocabulary)
        sequences = [[made.vocabulary[w] for w in words] for _, words in items]
        out: list[dict[int, int]] = [{}]
        made.links, made.lengths = [-1], [0]
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = made._grown(out, last, word)
        made.arcs = {s * n + w: t for s, arcs in enumerate(out) for w, t in arcs.items()}
        by_length = sorted(range(len(out)), key=made.lengths.__getitem__)
        made.window_state = [-1] * len(out)
        for s in by_length:
            if made.lengths[s] >= window:
                up = made.links[s]
                made.window_state[s] = s if made.lengths[up] < window else made.window_state[up]
        found: dict[int, set[str]] = {}
        short: dict[int, set[str]] = {}
        for (item, _), sequence in zip(items, sequences, strict=True):
            s = 0
            for i, word in enumerate(sequence, 1):
                s = made.arcs[s * n + word]
                if i >= window:
                    found.setdefault(made.window_state[s], set()).add(item)
            if 0 < len(sequence) < window:
                short.setdefault(s, set()).add(item)
        made.window_items = {s: sorted(ids) for s, ids in found.items()}
        # A state also ends with every short item on its way to the root.
        for s in by_length[1:]:
            own = [(made.lengths[s], sorted(short[s]))] if s in short else []
            if all_ := own + made.short_items.get(made.links[s], []):
                made.short_items[s] = all_
        lengths = [len(s) for s in sequences if s]
        made.shortest = min([window, *lengths])
        pairs = {a * n + b for s in sequences for a, b in zip(s, s[1:], strict=False)}
        made.pairs = np.array(sorted(pairs), np.int64)
        return made

    def _grown(self, out: list[dict[int, int]], last: int, word: int) -> int:
        """The state of the current item, one word longer."""
        known = out[last].get(word)
        if known is not None:
            if self.lengths[known] == self.lengths[last] + 1:
                return known
            return self._split(out, last, word, known)
        new = len(out)
        out.append({})
        self.lengths.append(self.lengths[last] + 1)
        self.links.append(0)
        p = last
        while p >= 0 and word not in out[p]:
            out[p][word] = new
            p = self.links[p]
        if p >= 0:
            q = out[p][word]
            fits = self.lengths[q] == self.lengths[p] + 1
            self.links[new] = q if fits else self._split(out, p, word, q)
        return new

    def _split(self, out: list[dict[int, int]], p: int, word: int, q: int) -> int:
        """A state for the stretches of `q` that are no longer than from `p`."""
        copy = len(out)
        out.append(dict(out[q]))
        self.lengths.append(self.lengths[p] + 1)
        self.links.append(self.links[q])
        self.links[q] = copy
        while p >= 0 and out[p].get(word) == q:
            out[p][word] = copy
            p = self.links[p]
        return copy

    def _stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Where a match can lie at all: runs of known words whose pairs all occur in items."""
        if self.shortest < 2:
            fit, least, extra = ids >= 0, 1, 0
        else:
            key = ids[:-1] * len(self.vocabulary) + ids[1:]
            place = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
            fit = (ids[:-1] >= 0) & (ids[1:] >= 0)
            if len(self.pairs):
                fit &= self.pairs[place] == key
            else:
                fit[:] = False
            least, extra = self.shortest - 1, 1
        edge = np.diff(np.concatenate(([0], fit.view(np.int8), [0])))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = stops - starts >= least
        return list(zip(starts[long].tolist(), (stops[long] + extra).tolist(), strict=True))

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit spans [start, stop) in order and apart, items, longest match."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        longest = 0
        if len(words) < self.shortest or not self.vocabulary:
            return spans, items, longest
        get, n = self.vocabulary.get, len(self.vocabulary)
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        arcs, links, lengths = self.arcs, self.links, self.lengths
        for start, stop in self._stretches(ids):
            s = length = 0
            for i, word in enumerate(ids[start:stop].tolist(), start):
                t = arcs.get(s * n + word)
                while t is None and s:
                    s = links[s]
                    length = lengths[s]
                    t = arcs.get(s * n + word)
                s, length = (0, 0) if t is None else (t, length + 1)
                longest = max(longest, length)
                hit = 0
                if length >= self.window:
                    hit = length
                    items.update(self.window_items.get(self.window_state[s], ()))
                for size, ids_ in self.short_items.get(s, ()):
                    if size <= length:
                        hit = max(hit, size)
                        items.update(ids_)
                if hit:
                    first = i + 1 - hit
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i + 1))
        return spans, items, longest


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@dataclass
class Block:
    """An automaton of some of the benchmark's texts, and the ids of the items of each text."""

    automaton: SuffixAutomaton
    ids: list[list[str]]

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        spans, texts, longest = self.automaton.match(words)
        return spans, {i for t in texts for i in self.ids[int(t)]}, longest


def automata(items: DataFrame, id_col: str, text_col: str, window: int) -> list[str]:
    """Files in the shared folder, each a `Block` of about BLOCK_WORDS words.

    Equal texts are one row before they are dealt out, so items that repeat a text, however
    many, share one sequence. Each attempt of a task writes a file of its own, and only
    those of finished tasks are listed.
    """
    spark = items.sparkSession
    texts = saved(
        items.select(
            F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
            F.col(text_col).alias("text"),
        )
        .where("length(text) > 0")
        .groupBy("text")
        .agg(F.sort_array(F.collect_set("id")).alias("ids")),
        "benchmark-texts",
    )
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_blocks = max(1, -(-size // (6 * BLOCK_WORDS)))
    folder = shared_folder(spark, "benchmark-automata")

    def build(table: pa.Table) -> pa.Table:
        found = [words_of(t) for t in text_bytes(table.column("text").combine_chunks())]
        sequences = [(str(i), words) for i, words in enumerate(found)]
        block = Block(SuffixAutomaton.of(sequences, window), table.column("ids").to_pylist())
        files, place = fs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        name = f"{uuid.uuid4().hex}.automaton"
        with files.open_output_stream(f"{place}/{name}") as out:
            pickle.dump(block, out, pickle.HIGHEST_PROTOCOL)
        return pa.table({"path": [f"{folder}/{name}"]})

    blocks = texts.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(n_blocks)))
    built = saved(blocks.groupBy("block").applyInArrow(build, "path string"), "benchmark-files")
    return sorted(row["path"] for row in built.collect())


def _loaded(paths: list[str]) -> list[Block]:
    """The blocks in these files, for as long as one task needs them."""
    blocks = []
    for path in paths:
        files, place = fs.FileSystem.from_uri(path)
        with files.open_input_file(place) as file:
            blocks.append(pickle.loads(file.read()))
    return blocks


def _passes(paths: list[str]) -> list[list[str]]:
    """The files that each pass over the documents carries; one pass at least."""
    return [paths[i : i + BLOCKS_PER_PASS] for i in range(0, max(len(paths), 1), BLOCKS_PER_PASS)]


_MATCH = (
    "n_words long, longest int, spans array<struct<start: int, stop: int>>, items array<string>"
)
_MATCH_TYPE = pa.struct(
    [
        ("n_words", pa.int64()),
        ("longest", pa.int32()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _matching(paths: list[str], text: Column, before: Column) -> Column:
    """What the blocks in these files, and those of the passes before, find in each text."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        forget_words()
        blocks = _loaded(paths)
        for texts, olds in batches:
            rows = []
            for text, old in zip(text_bytes(texts), olds.to_pylist(), strict=True):
                words = words_of(text)
                spans = [(x["start"], x["stop"]) for x in old["spans"]] if old else []
                found = set(old["items"]) if old else set()
                longest = old["longest"] if old else 0
                for block in blocks:
                    more, items, length = block.match(words)
                    spans += more
                    found |= items
                    longest = max(longest, length)
                rows.append(
                    {
                        "n_words": len(words),
                        "longest": longest,
                        "spans": [{"start": a, "stop": b} for a, b in _merged(spans)],
                        "items": sorted(found),
                    }
                )
            yield pa.array(rows, _MATCH_TYPE)
        give_back()

    return F.arrow_udf(run, _MATCH).asNondeterministic()(text, before)


def _matched_by(docs: DataFrame, paths: list[str], text_col: str, name: str) -> DataFrame:
    """`docs` with what all blocks find as column `name`; written between two passes."""
    out = docs.withColumn(name, F.lit(None).cast(f"struct<{_MATCH}>"))
    for i, own in enumerate(_passes(paths)):
        if i:
            out = saved(out, "decontamination")
        out = out.withColumn(name, _matching(own, out[text_col], out[name]))
    return out


def matched(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep_text: bool = True,
) -> DataFrame:
    """`docs` with a column `match`: n_words, longest, spans (of word positions), items.

    No shuffle: the documents are streamed past the automata, a few per pass where the
    benchmark needs several. A column `match` of `docs` is replaced.
    """
    kept = docs.select(*[c for c in docs.columns if c.lower() != "match"])
    out = _matched_by(kept, automata(items, item_id, item_text, window), text_col, "match")
    return out if keep_text else out.drop(text_col)


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = matched(docs.select(id_col, "text"), items, keep_text=False)
    hits = F.aggregate("match.spans", F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    joined = F.concat_ws(",", F.col("match.items"))
    return rows.select(
        id_col,
        F.col("match.n_words").alias("n_words"),
        hits.cast("long").alias("n_hit"),
        F.size("match.items").cast("long").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"),
        (F.size("match.spans") > 0).alias("contaminated"),
    )


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    marks = np.frombuffer(text.translate(_TO_WORDS), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], marks.view(np.int8), [0])))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at : starts[a]])
        at = stops[b - 1]
    return b"".join([*parts, text[at:]])


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    max_coverage: float = 0.5,
    text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """`docs` without the benchmark's passages; the columns stay the same.

    A document whose hit words are more than `max_coverage` of its words goes; from the
    others the hit spans are cut, and `n_chars`, where there is such a column, follows.
    Cutting joins what stood before and behind; should that make a new window, it is cut
    as well. Documents without a hit stay as they are. A benchmark of more blocks than a
    pass carries is matched by several, and so are the cut documents, until nothing is hit.
    """
    paths = automata(items, "item_id", "text", window)
    name = with_free_name(docs, "verdict")
    if len(paths) <= BLOCKS_PER_PASS:
        # Only texts go to the Python workers, and only those that are cut come back.
        found = docs.withColumn(name, _verdict(paths, max_coverage)(docs[text_col]))
        found = found.where(F.col(name)["stays"])
        text = F.coalesce(F.col(name)["cut"], found[text_col])
    else:
        found, text = _cut_by_passes(docs, paths, max_coverage, text_col, name)
    out = {c: found[c] for c in docs.columns}
    out[text_col] = text
    if "n_chars" in out and text_col != "n_chars":
        kind = docs.schema["n_chars"].dataType
        length = F.coalesce(F.length(out[text_col]), F.lit(0))
        out["n_chars"] = F.when(out["n_chars"].isNotNull(), length).cast(kind)
    return found.select(*[out[c].alias(c) for c in docs.columns])


def _verdict(paths: list[str], max_coverage: float):
    """Of a text: whether the document stays, and the text that is left if it is cut."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget_words()
        blocks = _loaded(paths)

        def spans_of(words: list[bytes]) -> list[tuple[int, int]]:
            return _merged([s for b in blocks for s in b.match(words)[0]])

        def judged(text: bytes) -> tuple[bool, bytes | None]:
            words = words_of(text)
            spans = spans_of(words)
            if sum(b - a for a, b in spans) > max_coverage * len(words):
                return False, None
            if not spans:
                return True, None
            while spans:
                text = _without(text, spans)
                spans = spans_of(words_of(text))
            return True, text

        for column in columns:
            stays, cut = [], []
            for text in text_bytes(column):
                kept, changed = judged(text)
                stays.append(kept)
                cut.append(changed)
            yield pa.StructArray.from_arrays(
                [pa.array(stays, pa.bool_()), pa.array(cut, pa.binary()).cast(pa.string())],
                names=["stays", "cut"],
            )
        give_back()

    return F.arrow_udf(run, "stays boolean, cut string").asNondeterministic()


def _cutting(text: Column, spans: Column) -> Column:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            cut = [
                _without(t, [(x["start"], x["stop"]) for x in own])
                for t, own in zip(text_bytes(texts), found.to_pylist(), strict=True)
            ]
            yield pa.array(cut, pa.binary()).cast(pa.string())

    return F.arrow_udf(run, "string")(text, spans)


def _cut_by_passes(
    docs: DataFrame, paths: list[str], max_coverage: float, text_col: str, name: str
) -> tuple[DataFrame, Column]:
    """The documents that stay, and their text, when the blocks need several passes."""
    found = saved(_matched_by(docs, paths, text_col, name), "decontamination")
    hit = F.size(found[name]["spans"]) > 0
    n_hit = F.aggregate(found[name]["spans"], F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    done = found.where(~hit)
    open_ = found.where(hit & (n_hit <= F.lit(float(max_coverage)) * found[name]["n_words"]))
    while not open_.isEmpty():
        cut = open_.withColumn(text_col, _cutting(open_[text_col], open_[name]["spans"]))
        cut = saved(cut.drop(name), "decontamination-cut")
        again = saved(_matched_by(cut, paths, text_col, name), "decontamination")
        hit = F.size(again[name]["spans"]) > 0
        done, open_ = done.unionByName(again.where(~hit)), again.where(hit)
    return done, done[text_col]
