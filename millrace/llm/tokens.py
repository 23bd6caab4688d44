"""Token ids of whole texts by public tokenizers, with a cache of pieces per worker.

The library splits a text into pre-tokens and encodes each alone.  Pieces that are
cut where the tokenizer always cuts can therefore be encoded once and looked up
afterwards.  The library encodes every piece that is new to a worker; the cache
of counts is emptied when it is full and that of ids drops what it has not met for
long, so their memory is bounded.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

CACHE_PIECES = 800_000
CACHE_PIECE_BYTES = 64  # longer pieces are encoded each time

# The White_Space characters of Unicode (fixed values).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A run of other characters with one space before it, or white space up to that space.
SPACED_PIECES = re.compile(f"[ ]?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# A word the tokenizer does not cut or compose: ASCII and Latin-1 letters.
_PLAIN = re.compile("([ ]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
MARKS = b".,!?;:*#$%&"  # never part of a word, a contraction or a special string


def _byte_letters() -> dict[int, str]:
    """The visible character that byte-level models have for each byte."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {**{b: chr(b) for b in seen}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


_LETTERS = _byte_letters()


class Library:
    """One tokenizer file opened by the tokenizers library in this process."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._tokenize = self.tokenizer.model.tokenize
        self._plain_form = self._find_plain_form()
        self.plain = self._plain_form is not None

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _find_plain_form(self):
        """How the model sees a plain word, if it sees it directly.

        Only its bytes need names, so the library's model can be asked without its
        normalizer and pre-tokenizer.  Tried on a few words with every letter; where
        any differs, every piece goes through the whole library.
        """
        forms = (lambda s, w: w.lower(), lambda s, w: s + w)
        words = ["the", "Of", "THANKS", "a", "interoperating", "Zzyzxq", "schön", "él"]
        words += [f"x{chr(c)}y" for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
        for form in forms:
            if all(
                self._model_ids(form(s, w)) == self.encode(s + w) and
                self._model_ids(form(s, w)) + self.encode(p) == self.encode(s + w + p)
                for s in ("", " ") for w in words for p in (".", ",")
            ):
                return form
        return None

    def _model_ids(self, piece: str) -> list[int]:
        if piece[0] == " " or not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_LETTERS)
        return [t.id for t in self._tokenize(piece)]

    @lru_cache(maxsize=16)  # noqa: B019  (one object per worker)
    def _mark(self, mark: str) -> list[int]:
        return self.encode(mark) if mark else []

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of one piece."""
        if self._plain_form and (m := _PLAIN.fullmatch(piece)):
            return self._model_ids(self._plain_form(m[1], m[2])) + self._mark(m[3])
        return self.encode(piece)

    def parts(self, text: str) -> list[str]:
        """``text`` cut around special strings, which are parts of their own."""
        if not any(s in text for s in self.specials):
            return [text]
        found = re.split("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")", text)
        return [p for p in found if p]


@lru_cache(maxsize=4)
def library(path: str) -> Library:
    return Library(path)


class LengthTable(dict):
    """Token counts of pieces: a fixed first tier, and what this worker met since."""

    def __init__(self, lib: Library, frequent: dict[str, int]):
        super().__init__(frequent)
        self.lib, self.frequent = lib, frequent

    def __missing__(self, piece: str) -> int:
        n = len(self.lib.piece_ids(piece))
        if len(piece) <= CACHE_PIECE_BYTES:
            if len(self) - len(self.frequent) >= CACHE_PIECES:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        get = self.__getitem__
        return sum(sum(map(get, SPACED_PIECES.findall(p))) for p in self.lib.parts(text))


class IdTable(dict):
    """Packed ids of white-space separated pieces, for tokenizers that drop white space.

    A piece is looked up in lower case where the tokenizer lower-cases itself, and
    marks after a plain word are looked up on their own.  When the table is full it
    becomes the older generation, from which pieces come back as they are met again:
    frequent pieces are not encoded anew, and what is met once is soon let go.
    """

    def __init__(self, lib: Library, pieces: int = CACHE_PIECES):
        super().__init__()
        self.lib, self.older, self.most = lib, {}, pieces // 2
        self.lower = lib.piece_ids("Word") == lib.piece_ids("word")
        self.specials = [x.encode() for x in lib.specials]
        self.code = "H" if lib.dtype.itemsize == 2 else "I"

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            body = piece.rstrip(MARKS)
            if body != piece and body.isalpha() and self.lib.plain:
                return self[body] + self[piece[len(body) :]]
            ids = array(self.code, self.lib.piece_ids(piece.decode("utf-8", "replace"))).tobytes()
        if len(piece) <= CACHE_PIECE_BYTES:
            if len(self) >= self.most:
                self.older = self.copy()
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """All ids of ``text``, little-endian, ``lib.dtype`` wide."""
        raw = text.encode("utf-8", "replace")
        if self.lower:
            small = raw.lower()
            if not any(s in small for s in self.specials):  # special strings are told by case
                raw = small
        return b"".join(map(self.__getitem__, raw.split()))


@lru_cache(maxsize=2)
def id_table(path: str, pieces: int = CACHE_PIECES) -> IdTable:
    return IdTable(library(path), pieces)
