"""Alignment of two tokenizers' tokens over the same text.

Both tokenizers read a blank and the text: a byte-level vocabulary (A) is given
both, a piece vocabulary (B) adds the blank itself. Each token covers a range of
bytes. Per batch, two ``merge_asof`` calls keyed by document find the token of the
other side that covers each token's start; together they give all overlaps, since of
two overlapping ranges one starts inside the other. Offsets where tokens of both
sides end cut the text into groups.

Texts that are null or empty have no tokens, and neither have texts whose bytes one
of the tokenizers changes. Special strings are plain text. Repeated rows are aligned
each for itself, null doc_ids are carried along, and only doc_id and text are read;
an empty table gives an empty result.

Corpus-wide counts stand in an array with one place for each pair of ids that can
end together. Of two such tokens one is a suffix of the other, so the places are
known from the vocabularies, about one per byte of both, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import stored, text_of
from wayfare.llm.tokens import byte_letters

#: Tokens of each side that are aligned at a time; a longer text is aligned alone.
BATCH_TOKENS = 100_000
#: Rows whose texts are encoded at a time.
SLICE_ROWS = 200
_BLANK = "▁"
#: Fixed value: how byte-level vocabularies of this kind cut texts into words.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ALIGNED = "doc_id bigint, a_ids binary, b_ids binary, overlap_a binary, overlap_b binary, group_a binary, group_b binary"
DIGESTED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, times binary"


def load_pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def byte_token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary, whose ids must stand in the order of its merges."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, cut = told["model"], told["pre_tokenizer"]
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    in_order = all(model["vocab"].get(m.replace(" ", "")) == 256 + at for at, m in enumerate(merges))
    if told["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or not in_order:
        raise ValueError(f"{path} is not a plain byte-level vocabulary")
    byte_of = {letter: byte for byte, letter in byte_letters().items()}
    out = [b""] * len(model["vocab"])
    for label, at in model["vocab"].items():
        out[at] = bytes(byte_of[c] for c in label)
    return out


def piece_token_bytes(model) -> list[bytes]:
    """The bytes of each id of a piece vocabulary."""
    out = []
    for at in range(model.get_piece_size()):
        piece = model.id_to_piece(at)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(at) else piece.replace(_BLANK, " ").encode())
    return out


def tokens_at(ids: list[int], tokens: list[bytes]) -> tuple[bytes, ...]:
    """The tokens of some ids, in their order."""
    return itemgetter(*ids)(tokens) if len(ids) > 1 else tuple(tokens[i] for i in ids)


class PairEncoder:
    """Ids of both sides of a blank and a text.

    The byte-level side goes through tiktoken with the vocabulary's own merges and
    pattern, which gives the same ids as the tokenizers library at a quarter of the time.
    """

    def __init__(self, byte_path: str, piece_path: str):
        import tiktoken

        self.a_bytes, self.model = byte_token_bytes(byte_path), load_pieces(piece_path)
        self.b_bytes = piece_token_bytes(self.model)
        self.a_length = np.array(list(map(len, self.a_bytes)), np.int64)
        ranks = {token: at for at, token in enumerate(self.a_bytes)}
        # without special tokens, their strings in a text are ordinary text
        self.library = tiktoken.Encoding(byte_path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def texts(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Both sides' ids of each text; none for empty texts and where the bytes of a side are not those of the blank and the text."""
        out = []
        for text, b in zip(texts, self.model.encode(texts, num_threads=1)):
            if not text:
                out.append((b"", b""))
                continue
            whole = b" " + text.encode()
            a = self.library.encode_to_numpy(" " + text, disallowed_special=())
            # the byte-level side cuts the bytes and changes none, so it has them all if it has as many
            same = self.a_length[a].sum() == len(whole) and b"".join(tokens_at(b, self.b_bytes)) == whole
            out.append((a.astype("<u4").tobytes(), np.array(b, "<u4").tobytes()) if same else (b"", b""))
        return out


_ENCODERS: dict[tuple[str, str], PairEncoder] = {}


def worker_encoder(byte_path: str, piece_path: str) -> PairEncoder:
    key = (byte_path, piece_path)
    if key not in _ENCODERS:
        _ENCODERS[key] = PairEncoder(byte_path, piece_path)
    return _ENCODERS[key]


@dataclass
class Side:
    """Tokens of one side of several documents, in order."""

    ids: np.ndarray
    doc: np.ndarray  # document of each token
    first: np.ndarray  # first token of each document, and one past the last
    start: np.ndarray  # in bytes from the first document's begin
    end: np.ndarray


def side_of(ids: list[bytes], lengths: np.ndarray) -> Side:
    counts = np.array([len(i) // 4 for i in ids], np.int64)
    flat = np.frombuffer(b"".join(ids), "<u4")
    end = np.cumsum(lengths[flat])
    first = np.concatenate([[0], np.cumsum(counts)])
    return Side(flat, np.repeat(np.arange(len(ids)), counts), first, end - lengths[flat], end)


def covering(side: Side, other: Side) -> np.ndarray:
    """The token of ``other`` that covers the start of each token of ``side``."""
    left = pd.DataFrame({"start": side.start, "doc": side.doc})
    right = pd.DataFrame({"start": other.start, "doc": other.doc, "token": np.arange(len(other.ids))})
    return pd.merge_asof(left, right, on="start", by="doc")["token"].to_numpy()


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token that share a byte, in order of A, then B."""
    width = max(1, len(b.ids))
    of_a = np.arange(len(a.ids)) * width + covering(a, b)
    of_b = covering(b, a) * width + np.arange(len(b.ids))
    both = np.sort(np.concatenate([of_a, of_b]).astype(np.int64), kind="stable")  # two runs in order each
    both = both[np.diff(both, prepend=-1) > 0]
    return both // width, both % width


def aligner(byte_path: str, piece_path: str):
    """A function for mapInArrow: doc_id, text to the columns of ``align``."""

    def emitted(doc_ids: list, ids: list[tuple[bytes, bytes]], a_length: np.ndarray, b_length: np.ndarray) -> pa.RecordBatch:
        a, b = side_of([i[0] for i in ids], a_length), side_of([i[1] for i in ids], b_length)
        at_a, at_b = overlaps(a, b)
        same_end = a.end[at_a] == b.end[at_b]
        columns: list[list[bytes]] = [[], [], [], []]
        doc = a.doc[at_a]
        ended = np.flatnonzero(same_end)
        cuts, end_cuts = np.searchsorted(doc, np.arange(len(ids) + 1)), np.searchsorted(doc[ended], np.arange(len(ids) + 1))
        for n in range(len(ids)):
            row = slice(cuts[n], cuts[n + 1])
            group = ended[end_cuts[n] : end_cuts[n + 1]]
            for out, at, first in ((0, at_a[row], a.first[n]), (1, at_b[row], b.first[n]), (2, at_a[group], a.first[n]), (3, at_b[group], b.first[n])):
                columns[out].append((at - first).astype("<u4").tobytes())
        arrays = [pa.array(doc_ids, pa.int64()), pa.array([i[0] for i in ids], pa.binary()), pa.array([i[1] for i in ids], pa.binary())]
        return pa.RecordBatch.from_arrays(
            [*arrays, *[pa.array(c, pa.binary()) for c in columns]],
            names=["doc_id", "a_ids", "b_ids", "overlap_a", "overlap_b", "group_a", "group_b"],
        )

    def align_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(byte_path, piece_path)
        a_length, b_length = (np.array(list(map(len, x)), np.int64) for x in (encoder.a_bytes, encoder.b_bytes))
        for batch in batches:
            doc_ids: list = []
            ids: list[tuple[bytes, bytes]] = []
            size = 0
            for part in (batch.slice(at, SLICE_ROWS) for at in range(0, batch.num_rows, SLICE_ROWS)):
                for doc_id, got in zip(part.column(0).to_pylist(), encoder.texts(part.column(1).to_pylist())):
                    doc_ids.append(doc_id)
                    ids.append(got)
                    size += len(got[0]) // 4
                    if size >= BATCH_TOKENS:
                        yield emitted(doc_ids, ids, a_length, b_length)
                        doc_ids, ids, size = [], [], 0
            if doc_ids:
                yield emitted(doc_ids, ids, a_length, b_length)

    return align_batches


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row per row of ``docs``: the ids of both sides, all overlaps and all groups.

    All but doc_id are little-endian unsigned 32-bit numbers. The n-th numbers of
    overlap_a and overlap_b are a pair of overlapping tokens, counted from 0 in the
    document; the n-th of group_a and group_b are the last tokens of the n-th group.
    """
    return texts_of(docs).mapInArrow(aligner(byte_path, piece_path), ALIGNED)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("t"))


def suffix_pairs(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """All pairs of ids of which one token is a suffix of the other, as sorted numbers a * B + b.

    A token has as many suffixes as bytes, so there are about as many pairs as bytes in both vocabularies.
    """
    by_bytes: list[dict[bytes, list[int]]] = [{}, {}]
    for side, tokens in zip(by_bytes, (a_bytes, b_bytes)):
        for at, token in enumerate(tokens):
            if token:
                side.setdefault(token, []).append(at)
    width, found = len(b_bytes), set()
    for a, token in enumerate(a_bytes):
        for cut in range(len(token)):
            found.update(a * width + b for b in by_bytes[1].get(token[cut:], ()))
    for b, token in enumerate(b_bytes):
        for cut in range(len(token)):
            found.update(a * width + b for a in by_bytes[0].get(token[cut:], ()))
    return np.array(sorted(found), np.int64)


def spelled_ids(n_a: int, n_b: int) -> np.ndarray:
    """The A ids before a comma, before a bar, then the B ids before a comma, before a semicolon: as texts that zeros fill up."""
    told = [b"%d%s" % (i, mark) for n, marks in ((n_a, (b",", b"|")), (n_b, (b",", b";"))) for mark in marks for i in range(n)]
    return np.array(told, "S8" if max(n_a, n_b) <= 10**7 else "S16")


def group_texts(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, spelled: np.ndarray, n_a: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3`` of one document, from the texts of ``spelled_ids``."""
    n_b = len(spelled) // 2 - n_a
    ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    ends_a[group_a], ends_b[group_b] = 1, 1
    of_a, of_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b  # group of each token
    before = np.concatenate([[0], group_b + 1])  # B tokens before each group
    through = group_a + 1  # A tokens up to each group's end
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + before[of_a]] = a + ends_a * n_a
    out[np.arange(len(b)) + through[of_b]] = 2 * n_a + b + ends_b * n_b
    return spelled[out].tobytes().translate(None, b"\0")[:-1]


def digester(shared, n_a: int, n_b: int):
    """A function for mapInArrow: the columns of ``align`` to counts, the digest of the groups, and the places of the pairs of ids that end together."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        spelled = spelled_ids(n_a, n_b)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                a, b, over_a, over_b, group_a, group_b = (np.frombuffer(p, "<u4").astype(np.int64) for p in packed)
                ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
                ends_a[group_a], ends_b[group_b] = True, True
                # overlapping tokens that both end a group end together: no other group's end lies in their common bytes
                link = ends_a[over_a] & ends_b[over_b]
                pairs, times = np.unique(a[over_a[link]] * n_b + b[over_b[link]], return_counts=True)
                sha = hashlib.sha256(group_texts(a, b, group_a, group_b, spelled, n_a)).hexdigest() if len(a) else ""
                rows.append((
                    doc_id, len(a), len(b), len(group_a), int(link.sum()), sha,
                    np.searchsorted(places, pairs).astype("<u4").tobytes(), times.astype("<u4").tobytes(),
                ))
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    return digest


def pair_counts(digested: DataFrame, n_places: int) -> np.ndarray:
    """How many links of the corpus hold each pair. Every task adds its own up first; the driver gets one number per place at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_places, np.int64)
        for batch in batches:
            at, times = (np.frombuffer(b"".join(c.to_pylist()), "<u4") for c in batch.columns)
            total += np.bincount(at, weights=times, minlength=n_places).astype(np.int64)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(total[place])], names=["place", "n"])

    summed = digested.select("pairs", "times").mapInArrow(add, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_places, np.int64)
    out[summed.column("place").to_numpy()] = summed.column("n").to_numpy()
    return out


def best_of_b(counts: np.ndarray, places: np.ndarray, n_b: int) -> np.ndarray:
    """True for pairs whose count is the highest of their B id."""
    b, highest = places % n_b, np.zeros(n_b, np.int64)
    np.maximum.at(highest, b, counts)
    return counts == highest[b]


def alignment_counts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    Links are the pairs of tokens that end together; a link's count is that of its
    pair of ids in the whole corpus, and it is best if no other pair with its B id
    has a higher one.
    """
    context = docs.sparkSession.sparkContext
    a_bytes, b_bytes = byte_token_bytes(byte_path), piece_token_bytes(load_pieces(piece_path))
    places = suffix_pairs(a_bytes, b_bytes)
    shared_places = context.broadcast(places)  # one place per suffix pair of the vocabularies, as are the counts
    aligned, digest = aligner(byte_path, piece_path), digester(shared_places, len(a_bytes), len(b_bytes))
    digested = stored(texts_of(docs).mapInArrow(lambda batches: digest(aligned(batches)), DIGESTED), "alignment")
    shared_places.destroy()
    counts = pair_counts(digested, len(places))
    shared = context.broadcast((counts, best_of_b(counts, places, len(b_bytes))))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            at, times = (batch.column(n).to_pylist() for n in (6, 7))
            n_best, count_sum = [], []
            for pairs, n in zip(at, times):
                pairs, n = np.frombuffer(pairs, "<u4"), np.frombuffer(n, "<u4").astype(np.int64)
                n_best.append(int(n[best[pairs]].sum()))
                count_sum.append(int((n * counts[pairs]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), batch.column(5)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return digested.mapInArrow(
        look_up, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    )
