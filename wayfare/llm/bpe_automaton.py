"""Byte-pair encoding and decoding by a tokenization automaton.

A state stands for the token that was read last, an arc's label for the token that
may come next. At first every symbol may follow every other. Then the merges come
in order, each as one gadget: after ``u`` the label ``v`` is cut; wherever ``u`` could
be read, ``uv`` can be read too; the state behind ``uv`` is a copy of the one behind
``v`` as it is at that moment. What is left are the pairs of tokens that can stand
side by side in an encoding, and each word has one path.

Only cuts are stored, with the rank of the merge that made them: a label grows from
its first symbol by merges on the right, so it may follow a state if the state never
cuts one of the label's first parts before that part has grown on (``goes``). A word
is read from left to right; the state after each of its beginnings is the one label
that ends there and may follow the state at its start.

Null texts count as empty; empty texts and texts of white space only have no ids and
decode to the empty text. Strings of special tokens inside a text become their ids,
as the library does by default. Repeated rows are encoded each for itself, null
doc_ids are carried along, and only doc_id and text are read; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import text_of
from wayfare.llm.tokens import byte_letters, little_endian, load

#: The state before the first token.
START = -1
#: Words that a worker remembers in each of two generations, and steps of the automaton.
CACHE_WORDS = 100_000
CACHE_STEPS = 200_000
#: Beginnings of words whose last label is remembered.
CACHE_BEGINNINGS = 150_000
LONGEST_CACHED = 48
#: Texts that are taken out of a batch at a time.
SLICE_ROWS = 200
#: Tokens of one batch that decoding gives back, about.
DECODED_TOKENS = 2_000_000


class Automaton:
    """States and cut arcs of a vocabulary with merges."""

    def __init__(self, ids: dict[str, int], merges: Iterable[tuple[str, str]], end: str = ""):
        self.ids, self.end = ids, end
        self.lengths = {at: len(label.removesuffix(end) if end else label) for label, at in ids.items()}
        #: what a label may end in, so that reading back stops where no label goes on
        self.tails = {label[at:] for label in ids for at in range(len(label))}
        #: of a label made by a merge: its left part, and the merge's rank
        self.left: dict[int, int] = {}
        self.rank: dict[int, int] = {}
        #: of a state: the labels cut from it, and the rank at which
        self.cuts: dict[int, dict[int, int]] = {}
        self.steps: dict[int, bool] = {}
        self.beginnings: dict[str, int] = {}
        self.unreachable: set[int] = set()
        merges = list(merges)
        later = {ids[u + v] for u, v in merges}  # labels that no merge has made yet
        for rank, (u, v) in enumerate(merges):
            if ids[u] in later or ids[v] in later:
                raise ValueError(f"{u!r} {v!r} comes before its parts")
            later.discard(ids[u + v])
            self._add_gadget(rank, u, v)

    def _add_gadget(self, rank: int, first: str, second: str) -> None:
        u, v, both = self.ids[first], self.ids[second], self.ids[first + second]
        if both in self.rank:
            raise ValueError(f"two merges make {first + second!r}")
        meet = u not in self.unreachable and v not in self.unreachable and self.goes(u, v)
        self.left[both], self.rank[both] = u, rank
        if v in self.cuts:
            self.cuts[both] = dict(self.cuts[v])
        if meet:
            self.cuts.setdefault(u, {})[v] = rank
        else:
            self.unreachable.add(both)

    def goes(self, state: int, label: int) -> bool:
        """True if the label may be read in the state."""
        cut = self.cuts.get(state)
        if state == START or not cut:
            return True
        grown = None  # the rank at which the part grew on
        while True:
            at = cut.get(label)
            # a merge of two equal tokens cuts and grows at one rank; the left one of three goes first
            if at is not None and (grown is None or at <= grown):
                return False
            if label not in self.left:
                return True
            grown, label = self.rank[label], self.left[label]

    def step(self, state: int, label: int) -> bool:
        """``goes`` of a label that can be reached, remembered in ``steps``."""
        if len(self.steps) > CACHE_STEPS:
            self.steps.clear()
        out = self.steps[(state + 1) << 24 | label] = label not in self.unreachable and self.goes(state, label)
        return out

    def last(self, letters: str, end: int, mark: str, states: list[int]) -> int:
        """The label that ends at ``end`` on the path, which follows the state at its own start; states are given up to there."""
        ids, steps, tails = self.ids, self.steps, self.tails
        for start in range(end - 1, -1, -1):
            tail = letters[start:end] + mark
            label = ids.get(tail)
            if label is not None:
                known = steps.get((states[start] + 1) << 24 | label)
                if self.step(states[start], label) if known is None else known:
                    return label
            elif tail not in tails:
                break
        raise ValueError(f"no path for {letters[:end]!r}")

    def word(self, letters: str) -> list[int]:
        """The labels on the word's path. Raises ValueError for a symbol that the vocabulary lacks."""
        whole = self.ids.get(letters + self.end)
        if whole is not None and whole not in self.unreachable:
            return [whole]
        size, known = len(letters), self.beginnings
        if len(known) > CACHE_BEGINNINGS:
            known.clear()
        states = [START]
        for end in range(1, size):
            beginning = letters[:end]
            label = known.get(beginning)
            if label is None:
                label = self.last(letters, end, "", states)
                if end <= LONGEST_CACHED:
                    known[beginning] = label
            states.append(label)
        states.append(self.last(letters, size, self.end, states))
        out, at, lengths = [], size, self.lengths
        while at:
            out.append(states[at])
            at -= lengths[states[at]]
        return out[::-1]


def characters(kind: str, last: int) -> str:
    """All characters up to ``last`` of a general category, as the inside of a pattern's class."""
    return "".join(re.escape(chr(c)) for c in range(last + 1) if unicodedata.category(chr(c)).startswith(kind))


#: Last of the Latin letters, in which no normal form changes a character and every one is known to all versions of Unicode.
LAST_LATIN = 0x24F
_BEYOND_LATIN = re.compile(f"[^\\x00-{chr(LAST_LATIN)}]")
_LETTERS, _NUMBERS, _WHITE = characters("L", LAST_LATIN), characters("N", LAST_LATIN), "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"
#: Fixed value, as the tokenizer's file has it: what is cut into words of lower case. White space is left out.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_WHITE}{_LETTERS}{_NUMBERS}]+")


class WordIds(dict):
    """The ids of words, as little-endian numbers; those that were asked for lately stay."""

    def __init__(self, automaton: Automaton, latin: bool):
        super().__init__()
        self.automaton, self.latin, self.letters, self.older = automaton, latin, byte_letters(), {}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            plain = self.latin and word.isascii() and word.isprintable()
            spelled = word if plain or not self.latin else "".join([self.letters[b] for b in word.encode()])
            out = little_endian(self.automaton.word(spelled))
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHE_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out


class AutomatonTokenizer:
    """The automaton of a tokenizer file, with the file's own rules for normal forms and for cutting texts into words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        if model["type"] != "BPE" or model["continuing_subword_prefix"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError("only plain byte-pair encodings are compiled")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        library = load(path)
        self.normal, self.cut = library.normalizer, library.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.labels = [""] * (max([*model["vocab"].values(), *self.special.values()]) + 1)
        for label, at in (model["vocab"] | self.special).items():
            self.labels[at] = label
        self.spaces_between = told["decoder"] is None
        self.bytes_of = {letter: byte for byte, letter in byte_letters().items()}
        # Latin texts are cut here, where the file's rules are the ones above; words of others are spelled in the byte alphabet
        cuts = [p.get("pattern", {}).get("Regex") for p in told["pre_tokenizer"].get("pretokenizers", [])]
        forms = [n["type"] for n in (told["normalizer"] or {}).get("normalizers", [])]
        self.cuts_latin = cuts == [WORD_PATTERN, None] and forms == ["NFC", "Replace", "Lowercase"]
        self.latin, self.spelled = WordIds(self.automaton, True), WordIds(self.automaton, False)

    def _pieces(self, text: str) -> list[str]:
        """The words of a text in the byte alphabet, by the library's normal forms and rules."""
        return [piece for piece, _ in self.cut.pre_tokenize_str(self.normal.normalize_str(text) if self.normal else text)]

    def _plain(self, text: str) -> bytes:
        if self.cuts_latin and not _BEYOND_LATIN.search(text):
            return b"".join(map(self.latin.__getitem__, _LATIN_WORDS.findall(text.lower())))
        return b"".join(map(self.spelled.__getitem__, self._pieces(text)))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.special_pattern or not self.special_pattern.search(text):
            return self._plain(text) if text else b""
        parts = self.special_pattern.split(text)
        return b"".join([little_endian([self.special[p]]) if p in self.special else self._plain(p) for p in parts if p])

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the ids, with blanks between them or, in byte-level vocabularies, as bytes."""
        labels = map(self.labels.__getitem__, ids.tolist())
        if self.spaces_between:
            return " ".join(labels)
        return bytes(map(self.bytes_of.__getitem__, "".join(labels))).decode("utf-8", "replace")


_TOKENIZERS: dict[str, AutomatonTokenizer] = {}


def worker_tokenizer(path: str) -> AutomatonTokenizer:
    """The compiled tokenizer of this Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = AutomatonTokenizer(path)
    return _TOKENIZERS[path]


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids: the ids of each text as little-endian unsigned 32-bit integers, one row per row."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(tokenizer_path)
        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            ids = [tokenizer.encode(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("t")).mapInArrow(encoded, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids, decoded: the text of the ids, special tokens included. Null ids count as none."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(tokenizer_path)
        for batch in batches:
            start = size = 0
            texts: list[str] = []
            for at, ids in enumerate(batch.column(1).to_pylist()):
                texts.append(tokenizer.decode(np.frombuffer(ids or b"", "<u4")))
                size += len(ids or b"") // 4
                if size > DECODED_TOKENS or at == batch.num_rows - 1:
                    part = batch.slice(start, at + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
                    start, size, texts = at + 1, 0, []

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decoded, "doc_id bigint, ids binary, decoded string")
