"""Token ids of texts by a public tokenizer, with a memory for its pieces.

Encoding a text is encoding its pieces where the tokenizer never merges across their
borders. A task asks the library for each piece once and remembers the answer, up to
`remembered` of them; words repeat, so most of a text is looked up.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

# Pieces that a Python worker remembers before it starts anew: some 100 MB.
PIECES = 500_000

# The library's own threads would compete with Spark's tasks.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# ASCII and Latin-1 letters: a run of them is one word for either kind of tokenizer.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# How byte-level models spell bytes: printable ones as themselves, the others in order
# from code point 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_SPELLED = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}

# A space with a character other than white space on both sides.
_CUT = re.compile(r"(?<=\S)(?= \S)")
# In UTF-8, what white space beyond ASCII begins with, and the control characters
# that only some libraries take for white space.
_ODD_SPACE = (
    *(bytes([c]) for c in (*range(0x1C, 0x20),)),
    b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80",
)


class _Memo(dict):
    """The ids of pieces, as little-endian bytes.

    Neither kind of tokenizer merges a letter with a comma or full stop behind it, so
    a word is encoded once for all three endings. A word of plain letters goes straight
    to the tokenizer's model; anything else passes all of its steps.
    """

    def __init__(self, encode, encode_word, prefix: bytes, size: int):
        super().__init__()
        self.encode, self.encode_word, self.prefix, self.size = encode, encode_word, prefix, size
        self.marks = {b",": encode(","), b".": encode(".")}

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= self.size:
            self.clear()
        mark = self.marks.get(piece[-1:])
        if mark is not None and piece[-2:-1].isalpha():
            value = self[piece[:-1]] + mark
        elif _LETTERS.fullmatch(piece):
            value = self.encode_word(self.prefix + piece)
        else:
            value = self.encode((self.prefix + piece).decode())
        self[piece] = value
        return value


class Encoder:
    """Ids of whole texts, without special tokens added.

    `borders` names where the tokenizer never merges: "words" when it ignores case,
    drops white space and works on each word alone; "spaces" when a word keeps the one
    space before it (byte-level pieces). Without it, each text goes to the library whole.
    """

    def __init__(self, path: str, borders: str | None = None, remembered: int = PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.borders = borders
        self.plain = _Memo(self._whole, self._word, b"", remembered)
        self.spaced = _Memo(self._whole, self._word, b" ", remembered)

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: bytes) -> bytes:
        if self.borders == "words":
            word = word.decode().lower().encode()
        spelled = word.decode("latin-1").translate(_SPELLED)
        return self._bytes([t.id for t in self.model.tokenize(spelled)])

    def _bytes(self, ids: list[int]) -> bytes:
        numbers = array(self.code, ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return numbers.tobytes()

    def encode(self, text: bytes) -> bytes:
        """The ids as little-endian numbers of `dtype`; `text` is UTF-8."""
        if self.borders == "words":
            return b"".join(map(self.plain.__getitem__, text.lower().split()))
        if self.borders != "spaces":
            return self._whole(text.decode())
        if not text:
            return b""
        if self._irregular(text):
            pieces = [p.encode() for p in _CUT.split(text.decode())]
            return b"".join(map(self.plain.__getitem__, pieces))
        out = []
        for line in text.split(b"\n"):
            first, *rest = line.split(b" ")
            out.append(self.plain[first])
            out.extend(map(self.spaced.__getitem__, rest))
            out.append(self.plain[b"\n"])
        return b"".join(out[:-1])

    @staticmethod
    def _irregular(text: bytes) -> bool:
        """Whether white space meets white space or an end, or is of an unusual kind."""
        return (
            text[:1].isspace()
            or text[-1:].isspace()
            or any(x in text for x in (b"  ", b" \n", b"\n ", b"\n\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            or any(x in text for x in _ODD_SPACE)
        )


_encoders: dict[tuple[str, str | None, int], Encoder] = {}


def encoder(path: str, borders: str | None, remembered: int = PIECES) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    key = (path, borders, remembered)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(path, borders, remembered)
    return _encoders[key]


def forget() -> None:
    """Drop what this Python worker remembers, for operators that run after a tokenizer's."""
    _encoders.clear()
