"""Quality rules: a threshold table compiled into one projection of text statistics.

The statistics of a text (lengths, symbols, stop words, lines, repeats) are expressions of
built-in functions over its whole text. A rule bounds the ratio of two of them. `compiled`
turns a table of rules into one boolean column each, so that judging a document is a scan and
a projection: no shuffle, no user functions, nothing kept per key.

A text is read as words between ASCII white space and as lines between line feeds. Defined results:

- a missing or empty text, or one of white space only, has no words and no lines; all of its
  statistics are 0, and a rule whose whole is 0 is kept,
- letters, words and lines count as they stand, whatever the length of the text; the repeats
  of very long texts cost a sort of their windows,
- a ratio that equals a bound keeps the rule,
- rows are judged one by one, so repeated rows get equal verdicts, and an empty table gives
  an empty result,
- columns of the input stay as they are, whatever their names; what is found is one struct
  under a name that the input does not have.

Words of windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import with_free_name

_SPACE = r"\x20\x09-\x0D"
_SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Frequent function words of the four languages of the documents.
STOP_WORDS = (
    "the of and to in is that it for was on with as be by are this at from an or "
    "de la le et les en des un du une que est pour par dans avec qui pas sur au "
    "el los las se del por con no su para es al lo y a "
    "der die und den von zu das sich mit auf für ist im nicht dem ein eine als"
).split()


@dataclass(frozen=True)
class Rule:
    """Bounds on 100 * part / whole, both ends allowed; None is no bound."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None

    def kept(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        holds = F.lit(True)
        if self.least is not None:
            holds = holds & (part >= self.least * whole)
        if self.most is not None:
            holds = holds & (part <= self.most * whole)
        return holds | (whole == 0)


# The least number of words, and the greatest share of them in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

RULES = [
    Rule("word_length", "word_chars", "n_words", least=150, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=50),
    Rule("stop_words", "n_stop_words", "n_words", least=3),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=40),
    Rule("shouting", "n_upper_words", "n_words", most=30),
]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words which the text has twice or more.

    The place of a window is packed below the bits of its hash, so that sorting plain numbers
    brings equal windows side by side. What the lost high bits let through is compared again.
    """

    def shift(way: str, value: Column, bits: Column) -> Column:
        return F.call_function(f"shift{way}", value, bits)

    def window(hashes: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])

    def within(hashes: Column, bits: Column) -> Column:
        last = F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))
        places = F.slice(F.sequence(F.lit(0), last), 1, last)
        packed = F.transform(places, lambda i: shift("left", window(hashes, i), bits).bitwiseOR(i))
        return _let(F.sort_array(packed), lambda ordered: alike(ordered, hashes, bits))

    def alike(ordered: Column, hashes: Column, bits: Column) -> Column:
        """The places of windows that occur again, counted out in order."""
        low = shift("left", F.lit(1), bits) - 1
        place = lambda j: F.get(ordered, j).bitwiseAND(low).cast("int")
        same = lambda j: shift("right", F.get(ordered, j).bitwiseXOR(F.get(ordered, j + 1)), bits)
        firsts = F.filter(F.sequence(F.lit(0), F.size(ordered)), lambda j: same(j) == 0)
        near = F.flatten(F.transform(firsts, lambda j: F.array(place(j), place(j + 1))))

        def confirmed(places: Column) -> Column:
            key = lambda j: window(hashes, F.get(places, j))
            return F.filter(places, lambda i, j: (key(j) == key(j - 1)) | (key(j) == key(j + 1)))

        return covered(F.sort_array(_let(F.array_distinct(near), confirmed)))

    def covered(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda done, i: F.struct(
                (done["n"] + F.least(F.lit(WINDOW), i - done["last"])).alias("n"), i.alias("last")
            ),
            lambda done: done["n"],
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    bits = F.length(F.bin(F.size(words)))
    return _let(hashes, lambda h: _let(bits, lambda b: within(h, b)))


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"[{_SPACE}]+")).otherwise(
        F.array().cast("array<string>")
    )


STATISTICS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_stop_words",
    "n_upper_words",
]


def _with_statistics(rows: DataFrame) -> DataFrame:
    """The statistics of the column `text`, which goes; `row` is left as it is."""
    text, words, lines = F.col("text"), F.col("words"), F.col("lines")
    word = lambda x: F.length(F.btrim(x, F.lit(_SPACES))) > 0
    parts = rows.withColumn("text", F.coalesce(text, F.lit(""))).withColumns(
        {"words": _words(text), "lines": F.filter(F.split(text, "\n"), word)}
    )
    shouted = lambda w: w.rlike("[A-Z]{2}") & ~w.rlike("[a-z]")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w)),
        "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_upper_words": F.size(F.filter(words, shouted)),
    }
    return parts.select("row", *[counts[k].cast("long").alias(k) for k in STATISTICS])


def base_failed() -> Column:
    """Too few words, or too many of them repeated."""
    n = F.col("n_words")
    return (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)


def compiled(rules: list[Rule] = RULES) -> dict[str, Column]:
    """A column `rule_<name>` for each rule: does the document keep it?"""
    return {f"rule_{rule.name}": rule.kept() for rule in rules}


def judged(
    docs: DataFrame, keep: list[str], rules: list[Rule] = RULES, text: str = "text"
) -> DataFrame:
    """The columns `keep` and a struct `quality` (or the next free name, `_quality`).

    It holds the statistics, every rule, `base_failed`, and `kept` for all of them.
    """
    slim = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    verdicts = {"base_failed": base_failed(), **compiled(rules)}
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & F.col(f"rule_{rule.name}")
    found = _with_statistics(slim).withColumns(verdicts).withColumn("kept", kept)
    quality = F.struct(*STATISTICS, *verdicts, "kept")
    return found.select("row.*", quality.alias(with_free_name(docs.select(*keep), "quality")))


def filtered(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that keep every rule, with all of their columns."""
    found = judged(docs, docs.columns, rules, text)
    return found.where(F.col(found.columns[-1])["kept"]).select(*docs.columns)
