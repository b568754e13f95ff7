"""Language identification in two steps: first the family, then the language in it.

A text is a vector of frequencies of hashed byte pairs and triples. Linear support
vector machines, one for each two families, vote for the family; then those for each two
languages of that family vote for the language. They are trained on a sample of the
labelled documents that is bounded per language, each machine in a task of its own; the
driver gets their weights only. The whole text counts, in training and in prediction.

A missing text, or one without a letter, is `und` with score 0. A score is the least
confidence on the way, from 0 to 1; votes that tie go to the larger sum of margins, then
to the first name. With one labelled language every text with a letter gets it, with
none every text is `und`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm import tokens
from hitledger.llm.common import give_back, saved, text_bytes, with_free_name

UNKNOWN = "und"
# Labelled documents per language that training takes, at most.
SAMPLE_PER_LANGUAGE = 500
FEATURES = 4096
# Bytes of a text that are counted at a time.
SLICE = 1 << 20
# Vectors of the sample in one row, and features that one task takes the deviations of.
PART = 250
WIDTH = 128

# Families of languages by code; one that is not listed is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "indic": "hi bn mr gu pa ur ne si",
    "turkic": "tr az kk uz ky tt",
    "uralic": "fi et hu",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

_LOWER = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def frequencies(text: bytes) -> np.ndarray:
    """Counts of hashed byte pairs and triples over the number of bytes.

    Letters of ASCII and Latin-1 are in lower case, other ASCII characters are spaces.
    """
    counts = np.zeros(FEATURES)
    letters = text.translate(_LOWER)
    for at in range(0, len(letters), SLICE):
        b = np.frombuffer(letters[at : at + SLICE + 2], np.uint8).astype(np.uint32)
        capital = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)) + 1
        b[capital] += 0x20
        pairs = b[:-1] * np.uint32(257) + b[1:]
        triples = pairs[:-1] * np.uint32(65_599) + b[2:]
        for grams in (pairs, triples):
            places = (grams * np.uint32(2_654_435_769)) >> np.uint32(20)
            counts += np.bincount(places, minlength=FEATURES)
    return counts / max(1, len(text))


def has_letter(text: bytes) -> bool:
    letters = text.translate(_LOWER)
    if any(letters.find(c) >= 0 for c in (b"e", b"a", b"i", b"n")):
        return True
    return any(c.isalpha() for c in text.decode())


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, turns: int = 30) -> np.ndarray:
    """Weights of a linear support vector machine by dual coordinate descent; y is +1 or -1."""
    rng = np.random.default_rng(1)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    square = np.maximum([(row * row).sum() for row in x], 1e-12)
    for _ in range(turns):
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (w @ x[i]) - 1) / square[i], 0.0), cost)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


@dataclass
class Choice:
    """One-versus-one machines between some names."""

    names: list[str]
    weights: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, names: list[str], machines: Iterable[np.ndarray], scale: np.ndarray) -> Choice:
        """Of the machines for each two of the names, in the order of their combinations."""
        found = list(machines)
        weights = np.array([w[:-1] for w in found]).reshape(len(found), FEATURES).T
        return cls(names, weights * scale[:, None], np.array([w[-1] for w in found]))

    def best(self, x: np.ndarray) -> tuple[str, float]:
        if len(self.names) == 1:
            return self.names[0], 1.0
        margins = (x @ self.weights + self.offsets).tolist()
        votes = {n: [0, 0.0, 1.0] for n in self.names}
        for (a, b), m in zip(combinations(self.names, 2), margins, strict=True):
            for name, own in ((a, m), (b, -m)):
                vote = votes[name]
                vote[0] += own >= 0
                vote[1] += own
                vote[2] = min(vote[2], 1 / (1 + np.exp(-2 * np.clip(own, -20, 20))))
        name = max(self.names, key=lambda n: (votes[n][0], votes[n][1]))
        return name, float(votes[name][2])


@dataclass
class Model:
    families: Choice | None
    languages: dict[str, Choice]

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if self.families is None or not text or not has_letter(text):
            return UNKNOWN, 0.0
        x = frequencies(text)
        family, sure = self.families.best(x)
        language, surer = self.languages[family].best(x)
        return language, min(sure, surer)


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return _FAMILY.get(code, f"only {language}")


def _least(parts: list[np.ndarray], n: int) -> np.ndarray:
    """The `n` least of the different numbers."""
    return np.unique(np.concatenate(parts))[:n]


def _least_hashes(known: DataFrame, n: int) -> dict[str, int]:
    """Per language the greatest of the `n` least hashes of its different texts.

    Each task packs its own least hashes, so that copies count once and few are shuffled.
    """
    kind = "lang string, hashes binary"

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            codes, hashes = langs.indices.to_numpy(), batch.column("hash").to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                least[lang] = _least([least.get(lang, hashes[:0]), hashes[codes == code]], n)
        rows = [pa.array(list(least), pa.string()), pa.array([x.tobytes() for x in least.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(rows, names=["lang", "hashes"])

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        found = _least([np.frombuffer(x, "<i8") for x in table.column("hashes").to_pylist()], n)
        return pa.table({"lang": [key[0].as_py()], "last": [int(found[-1])]})

    packed = known.select("lang", "hash").mapInArrow(own, kind)
    rows = packed.groupBy("lang").applyInArrow(merged, "lang string, last long").collect()
    return {r["lang"]: r["last"] for r in rows}


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(x.astype("<f4").tobytes(), 1)


def _unpack(part: bytes, width: int = FEATURES) -> np.ndarray:
    return np.frombuffer(zlib.decompress(part), "<f4").reshape(-1, width)


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by([("lang", "ascending"), ("part", "ascending")])


def _vectors(texts: DataFrame) -> DataFrame:
    """(lang, part, n, x) of (lang, text): a language's n vectors in their order, PART in a row."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                found = batch.column("text").filter(pa.array(langs.indices.to_numpy() == code))
                for at in range(0, len(found), PART):
                    x = np.stack([frequencies(t) for t in text_bytes(found.slice(at, PART))])
                    row = [pa.array([lang], pa.string()), pa.array([_pack(x)], pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, names=["lang", "x"])
        give_back()

    def ordered(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(row.tobytes() for part in table.column("x").to_pylist() for row in _unpack(part))
        parts = [rows[at : at + PART] for at in range(0, len(rows), PART)]
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * len(parts), pa.string()),
                "part": pa.array(range(len(parts)), pa.int32()),
                "n": pa.array(map(len, parts), pa.int32()),
                "x": pa.array([zlib.compress(b"".join(p), 1) for p in parts], pa.binary()),
            }
        )

    packed = texts.mapInArrow(own, "lang string, x binary")
    return packed.groupBy("lang").applyInArrow(ordered, "lang string, part int, n int, x binary")


def _deviations(sample: DataFrame) -> np.ndarray:
    """The standard deviation of each feature; a task takes WIDTH of them from all vectors."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = range(0, FEATURES, WIDTH)
        for batch in batches:
            for row in batch.to_pylist():
                x = _unpack(row["x"])
                columns = [
                    pa.array(firsts, pa.int32()),
                    pa.array([row["lang"]] * len(firsts), pa.string()),
                    pa.array([row["part"]] * len(firsts), pa.int32()),
                    pa.array([_pack(x[:, at : at + WIDTH]) for at in firsts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["first", "lang", "part", "x"])

    def spread(key: tuple, table: pa.Table) -> pa.Table:
        parts = [_unpack(x, WIDTH) for x in _in_order(table).column("x").to_pylist()]
        found = np.concatenate(parts).astype(float).std(axis=0)
        return pa.table({"first": pa.array([key[0].as_py()], pa.int32()), "spread": [found]})

    slices = sample.select("lang", "part", "x").mapInArrow(sliced, "first int, lang string, part int, x binary")
    found = slices.groupBy("first").applyInArrow(spread, "first int, spread array<double>").collect()
    return np.concatenate([r["spread"] for r in sorted(found, key=lambda r: r["first"])])


def _machines(sample: DataFrame, pairs: list[tuple[list[str], list[str]]], scale: np.ndarray) -> list[np.ndarray]:
    """The machine of each pair of groups of languages, trained in a task."""

    def trained(key: tuple, table: pa.Table) -> pa.Table:
        tokens.forget()
        table = _in_order(table)
        n = sum(table.column("n").to_pylist())
        x, y, at = np.ones((n, FEATURES + 1)), np.empty(n), 0
        # One part at a time is unpacked beside the matrix.
        for part, side in zip(table.column("x"), table.column("side").to_pylist(), strict=True):
            own = _unpack(part.as_py())
            x[at : at + len(own), :-1] = own
            y[at : at + len(own)] = side
            at += len(own)
        x[:, :-1] *= scale
        w = linear_svm(x, y).tobytes()
        return pa.table({"pair": pa.array([key[0].as_py()], pa.int32()), "w": pa.array([w], pa.binary())})

    sides = []
    for i, (first, second) in enumerate(pairs):
        sides += [(i, name, 1.0) for name in first] + [(i, name, -1.0) for name in second]
    if not sides:
        return []
    dealt = F.broadcast(sample.sparkSession.createDataFrame(sides, "pair int, lang string, side double"))
    rows = sample.join(dealt, "lang").groupBy("pair").applyInArrow(trained, "pair int, w binary").collect()
    return [np.frombuffer(r["w"]) for r in sorted(rows, key=lambda r: r["pair"])]


def train(
    docs: DataFrame,
    usable: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model:
    """A model from the `usable` rows with text and language, sampled by a hash of the text.

    The sample of a language is its different texts with the least hashes, `per_language`
    of them or all there are: copies count once, and no labelled language is left out.
    Their vectors of FEATURES numbers stay in the shared folder; each machine is trained
    in a task, on the languages it tells apart.
    """
    known = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("hash")
    )
    last = _least_hashes(known, per_language)
    if not last:
        return Model(None, {})
    limit = F.create_map(*[F.lit(v) for pair in last.items() for v in pair])
    # A text that very many rows repeat is one text of the sample.
    texts = known.where(F.col("hash") <= limit[F.col("lang")]).select("lang", "text").distinct()
    sample = saved(_vectors(texts), "language-sample")
    scale = 1 / (_deviations(sample) + 1e-4) / np.sqrt(FEATURES)
    members: dict[str, list[str]] = {}
    for name in sorted(last):
        members.setdefault(family_of(name), []).append(name)
    families = sorted(members)
    pairs = [(members[a], members[b]) for a, b in combinations(families, 2)]
    pairs += [([a], [b]) for f in families for a, b in combinations(members[f], 2)]
    machines = iter(_machines(sample, pairs, scale))

    def choice(names: list[str]) -> Choice:
        return Choice.of(names, (next(machines) for _ in combinations(names, 2)), scale)

    return Model(choice(families), {f: choice(members[f]) for f in families})


def identified(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs`, or its columns `keep`, with a struct `language`: name and score.

    Where a kept column has that name, the struct takes the next free one, `_language`; it is
    always the last. Only the text goes to the Python workers, and only the struct comes back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens.forget()
        for column in texts:
            names, scores = [], []
            for text in text_bytes(column):
                name, score = shared.value.predict(text)
                names.append(name)
                scores.append(score)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["name", "score"]
            )
        give_back()

    # Filters on the result would otherwise be computed on their own, a second time.
    language = F.arrow_udf(predict, "name string, score double").asNondeterministic()
    kept = docs.select(*(docs.columns if keep is None else keep))
    return docs.select(*kept.columns, language(docs[text_col]).alias(with_free_name(kept, "language")))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`docs` with the predicted language, in the place of the label, if there was one.

    Only documents of no language are rejected, those without a text or without a letter:
    there is nothing to tell a language by. A prediction that differs from the label is no
    reason to drop a document.
    """
    columns = docs.columns
    found = identified(docs, model, text_col)
    name = F.col(found.columns[-1])["name"]
    return found.where(name != UNKNOWN).select(
        *[name.alias(c) if c == lang_col else F.col(f"`{c}`") for c in columns]
    )
