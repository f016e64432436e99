"""Ids of whole texts, equal to the tokenizer library's, from cached ids of blank-separated units."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

#: Units kept per Python worker, in two generations: at half as many the older one is forgotten.
CACHE_UNITS = 400_000
LONGEST_CACHED = 48
_SPACE_THEN_BLANK = re.compile(r"\s ")
#: Latin letters that no normal form changes, and a run of marks that every pattern takes as one piece.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:*#$%&|]*)")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is visible in Latin-1, else a later one."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class UnitCache(dict):
    """What the ids of a unit are worth, found out when a unit is first asked for.

    A plain unit, letters and then marks, goes to the merges directly; any other
    one goes through the library as a whole. ``value`` of joined ids must be the sum of
    their values: then letters and marks are kept by value, and a unit adds two up.
    """

    def __init__(self, library, keep_blank: bool, value: Callable[[list[int]], object]):
        super().__init__()
        self.library, self.value, self.keep_blank = library, value, keep_blank
        self.letters, self.merge = byte_letters(), library.model.tokenize
        self.words: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def merged(self, piece: str):
        spelled = piece if piece.isascii() and " " not in piece else "".join([self.letters[b] for b in piece.encode()])
        out = self.words[piece] = self.value([t.id for t in self.merge(spelled)])
        return out

    def __missing__(self, unit: str):
        if len(unit) > LONGEST_CACHED:
            return self.found(unit, None)
        out = self.older.pop(unit, None)
        if out is None:
            out = self.found(unit, _PLAIN.fullmatch(unit))
        self[unit] = out
        return out

    def found(self, unit: str, plain: re.Match | None):
        if plain is None:
            spelled = " " + unit if self.keep_blank else unit
            return self.value(self.library.encode(spelled, add_special_tokens=False).ids)
        word, marks = plain.groups()
        word = " " + word if self.keep_blank else word.lower()
        out = self.words.get(word)
        if out is None:
            out = self.merged(word)
        if marks:
            tail = self.words.get(marks)
            out = out + (self.merged(marks) if tail is None else tail)
        return out

    def trim(self) -> None:
        if len(self) > CACHE_UNITS // 2:
            self.older = dict(self)
            self.clear()
        if len(self.words) > CACHE_UNITS:
            self.words.clear()


class UnitEncoder:
    """Encodes texts unit by unit and remembers the units.

    Neither vocabulary has a token across the place between a character that is no
    white space and a blank, so ids of a text are those of its units in order. With
    ``keep_blank`` (byte-level vocabularies) the blank belongs to the unit after it,
    and a text with white space before a blank is encoded as a whole; without, white
    space has no ids. ``value`` turns a list of ids into what is kept for a unit.
    """

    def __init__(self, path: str, keep_blank: bool, value: Callable[[list[int]], object]):
        self.library, self.keep_blank, self.value = load(path), keep_blank, value
        self.cache = UnitCache(self.library, keep_blank, value)

    def _whole(self, text: str):
        return self.value(self.library.encode(text, add_special_tokens=False).ids)

    def text(self, text: str) -> list:
        """The kept values of a text's units, in order."""
        cache = self.cache
        cache.trim()
        if not self.keep_blank:
            return list(map(cache.__getitem__, text.replace("\n", " ").split(" ")))
        if _SPACE_THEN_BLANK.search(text):
            return [self._whole(text)]
        units = text.split(" ")
        out = list(map(cache.__getitem__, units))
        out[0] = self._whole(units[0])
        return out


_ENCODERS: dict[tuple, UnitEncoder] = {}


def worker_encoder(path: str, keep_blank: bool, value: Callable[[list[int]], object]) -> UnitEncoder:
    """The encoder of this Python worker, so that later tasks find its cache warm."""
    key = (path, keep_blank, value)
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(path, keep_blank, value)
    return _ENCODERS[key]


def little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
