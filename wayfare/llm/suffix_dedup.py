"""Removal of repeated byte strings across documents, by suffix arrays per shard and a merge by binary search.

A byte goes if it lies in a string of ``window`` bytes that also starts in a
document with a smaller doc_id; matches are judged on the input and never cross
documents. Documents are dealt to blocks of a fixed size, once for all steps:

1. Every window of a document is named by the smallest digest of the grams in it,
   so equal windows have equal names. A block sends each of its names once, in one
   packet per part of the names; the part answers each packet with one bit per name,
   set if another block sent the name too. A window whose name no other document
   uses is repeated nowhere. The answer says no more in a large table than in a
   small one, since it is no bitmap of a fixed size that fills up.
2. Shards: a block gathers the marked stretches of its documents up to a fixed
   size and sorts them with a suffix array. Where neighbours share ``window``
   bytes, all starts but those in the smallest document are repeats. What is left,
   one document per string and shard, goes to the part of its name, in one packet
   per block and part.
3. Merge: a part sorts what the blocks sent and looks every window up in it by
   binary search; windows of larger documents than the smallest found are repeats.
   Where there are very many shards, groups of them are merged first, and what is
   left of each group goes on, so no task gets a string once per shard.
4. Repeats meet the documents of their block again and are cut out.

A string that fills a third of the table is thus sent once per shard, and beyond
``SHARDS`` shards once per group of these. Null texts
are empty; texts shorter than a window stay whole. Rows with the same doc_id do
not affect each other, and null doc_ids count as larger than all others; a row is
known by its doc_id and 32 bits of a digest of doc_id and text, and dealt by the
latter, so copies of a text spread over all blocks. Texts
are cut to overlapping pieces, so that one of any length fits. All columns of the
input are kept, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import free_names, hands_back, mixed, packed_numbers, text_bytes, unpacked_numbers
from wayfare.llm.suffix_arrays import byte_words, common_prefixes, suffix_array

WINDOW = 50
GRAM = 20
SHARD_BYTES = 1 << 20
PIECE_BYTES = 1 << 19
#: Bytes of text per block of documents, per part of the names and per part of the merge. Packets go from each block to
#: each part, so their number grows with the product of both; below SMALL blocks they are smaller, for the cores' sake.
BLOCK_BYTES = 16 << 20
NAME_PART_BYTES = 32 << 20
PART_BYTES = 4 << 20
SMALL = 128
#: Shards whose strings are merged at a time: a string of a name has some 100 bytes in a packet, 6 MB from so many shards.
SHARDS = 1 << 16
NO_ID = np.iinfo(np.int64).max
NO_BYTES = np.zeros(0, np.uint8)
ODD = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
)]


def names(text: np.ndarray, window: int) -> np.ndarray:
    """The name of the window at each start: the smallest digest of its grams."""
    words = byte_words(text, "<u8")
    count = len(text) - GRAM + 1
    least = mixed(words[:count] * ODD[0] + words[8 : 8 + count] * ODD[1] + words[GRAM - 8 : GRAM - 8 + count] * ODD[2])
    want, have = window - GRAM + 1, 1
    while 2 * have <= want:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < want:
        least = np.minimum(least[: len(least) - (want - have)], least[want - have :])
    return least


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return starts, np.append(starts[1:], len(values))


def distinct(values: np.ndarray) -> np.ndarray:
    """The values in order, each once; for many numbers a sort is quicker than the hash table of ``np.unique``."""
    values = np.sort(values)
    return values[runs(values)[0]] if len(values) else values


def doc_numbers(docs: pa.Table) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in docs.column("doc_id").to_pylist()], np.int64)


@dataclass
class Piece:
    """A piece of a document: (doc_id, text digest), offset and bytes, first starts of the runs of windows with equal names and their end, and the names."""

    owner: tuple[int, int]
    at: int
    data: np.ndarray
    edges: np.ndarray
    key: np.ndarray


def pieces(docs: pa.Table, row: str, text: str, window: int) -> Iterator[Piece]:
    """Overlapping pieces of a block's documents; every window is in exactly one."""
    for doc_id, digest, value in zip(doc_numbers(docs).tolist(), docs.column(row).to_pylist(), docs.column(text)):
        data = np.frombuffer(value.as_buffer(), np.uint8) if len(value.as_buffer()) else NO_BYTES
        for at in range(0, len(data) - window + 1, PIECE_BYTES):
            part = data[at : at + PIECE_BYTES + window - 1]
            least = names(part, window)
            starts = runs(least)[0]
            yield Piece((doc_id, digest), at, part, np.append(starts, len(least)).astype(np.int32), mixed(least[starts]))


def by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part and the places of its members."""
    order = np.argsort(part, kind="stable")
    starts, ends = runs(part[order])
    for a, b in zip(starts, ends):
        yield int(part[order[a]]), order[a:b]


def cut_names(key: np.ndarray, bits: int) -> np.ndarray:
    """Names as they are sent: the part of the name in ``bits`` bits, then 32 more bits of it."""
    return key >> np.uint64(32 - bits)


def name_parts(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of cut names in order: each part, and where its names start and end."""
    part = (found >> np.uint64(32)).astype(np.int64)
    starts, ends = runs(part)
    return part[starts], starts, ends


NAMES = "part int, block int, names binary"
MARKS = "part int, block int, bits binary"


def namer(row: str, text: str, block: str, window: int, bits: int):
    """Step 1, for applyInArrow by block: the names of a block in order, each once, in packets by part."""

    def name(docs: pa.Table) -> pa.Table:
        keys = [x.key for x in pieces(docs, row, text, window)]
        parts, blobs = NO_BYTES, []
        if keys:
            found = distinct(cut_names(np.concatenate(keys), bits))
            parts, starts, ends = name_parts(found)
            inside = (found & np.uint64(0xFFFFFFFF)).astype(np.int64)
            blobs = [packed_numbers(np.diff(inside[a:b], prepend=0), 4) for a, b in zip(starts, ends)]
        own = [docs.column(block)[0].as_py()] * len(blobs)
        return pa.table({"part": pa.array(parts, pa.int32()), "block": pa.array(own, pa.int32()), "names": pa.array(blobs, pa.binary())})

    return hands_back(name)


def mark(group: pa.Table) -> pa.Table:
    """For applyInArrow by part of the names: for each packet one bit per name, set if it is in another packet as well."""
    packets = [x.as_py() for x in group.column("names")]
    found = np.concatenate([np.cumsum(unpacked_numbers(x, 4, len(x) // 4), dtype=np.uint64) for x in packets])
    order = np.sort((found << np.uint64(32)) | np.arange(len(found), dtype=np.uint64))
    same = np.flatnonzero((order[1:] >> np.uint64(32)) == (order[:-1] >> np.uint64(32)))
    place = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    twice = np.zeros(len(found), bool)
    twice[place[same]] = twice[place[same + 1]] = True
    ends = np.cumsum([len(x) // 4 for x in packets])
    bits = [np.packbits(twice[b - len(x) // 4 : b], bitorder="little").tobytes() for x, b in zip(packets, ends)]
    return pa.table({"part": group.column("part"), "block": group.column("block"), "bits": pa.array(bits, pa.binary())})


def marked(found: list[Piece], marks: pa.Table, bits: int) -> list[np.ndarray]:
    """For each piece of a block, which runs have a name that another document uses: one of the block, or of another as the marks say."""
    known, place = np.unique(cut_names(np.concatenate([x.key for x in found]), bits), return_inverse=True)
    places = np.split(place, np.cumsum([len(x.key) for x in found])[:-1])
    use = np.bincount(np.concatenate([distinct(x) for x in places]), minlength=len(known)) > 1
    answers = dict(zip(marks.column("part").to_pylist(), marks.column("bits").to_pylist()))
    for part, a, b in zip(*name_parts(known)):
        use[a:b] |= np.unpackbits(np.frombuffer(answers[int(part)], np.uint8), count=b - a, bitorder="little").view(bool)
    return [use[x] for x in places]


@dataclass
class Shard:
    """Marked stretches of some documents: their bytes, and for each position its document, row, place, window's name, and whether a marked window starts there."""

    text: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    place: np.ndarray
    name: np.ndarray
    starts: np.ndarray


def shards_of(found: list[Piece], hits: list[np.ndarray], window: int) -> Iterator[Shard]:
    """The marked stretches of a block's pieces, gathered up to SHARD_BYTES."""
    text = np.concatenate([x.data for x in found])
    base = np.cumsum([0, *(len(x.data) for x in found)])
    at, doc, row = np.array([x.at for x in found]), np.array([x.owner[0] for x in found]), np.array([x.owner[1] for x in found])
    piece = np.repeat(np.arange(len(found)), [len(x.key) for x in found])
    low, high = np.concatenate([x.edges[:-1] for x in found]).astype(np.int64), np.concatenate([x.edges[1:] for x in found]).astype(np.int64)
    key, hit = np.concatenate([x.key for x in found]), np.concatenate(hits)
    a, b = segment_stretches(hit, piece)  # neighbouring marked runs form one stretch
    length = high[b] - low[a] + window - 1
    size = np.cumsum(length)
    i = 0
    while i < len(a):
        j = int(np.searchsorted(size, size[i] - length[i] + SHARD_BYTES)) + 1
        n, of = length[i:j], piece[a[i:j]]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = step + np.repeat(low[a[i:j]], n)
        starts = step < np.repeat(n - window + 1, n)
        name = np.zeros(len(step), np.uint64)
        run = a[i] + np.flatnonzero(hit[a[i] : b[min(j, len(b)) - 1] + 1])
        name[starts] = np.repeat(key[run], high[run] - low[run])
        yield Shard(text[place + np.repeat(base[of], n)], np.repeat(doc[of], n), np.repeat(row[of], n), place + np.repeat(at[of], n), name, starts)
        i = j


def stretches(use: np.ndarray, row: np.ndarray, place: np.ndarray, name: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last position of each stretch of used starts that follow each other in a row (and share a name)."""
    at = np.flatnonzero(use)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]]) | (place[at[1:]] != place[at[:-1]] + 1)
    if name is not None:
        new[1:] |= name[at[1:]] != name[at[:-1]]
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1]


def segment_stretches(use: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of used windows that follow each other in a segment."""
    edge = use[1:] & use[:-1] & (segment[1:] == segment[:-1])
    return np.flatnonzero(use & ~np.append(False, edge)), np.flatnonzero(use & ~np.append(edge, False))


SENT = "kind int, part int, salt int, data binary"
REPEATS, SEGMENTS = 1, 0


def sent(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    kinds, parts, data = zip(*rows) if rows else ((), (), ())
    return pa.table({"kind": pa.array(kinds, pa.int32()), "part": pa.array(parts, pa.int32()), "data": pa.array(data, pa.binary())})


def row_key(doc: np.ndarray, row: np.ndarray) -> np.ndarray:
    """One number for a doc_id and the digest of its text."""
    return mixed(doc.astype(np.uint64) * ODD[1] + row.astype(np.uint64)).view(np.int64)


def repeat_rows(doc: np.ndarray, row: np.ndarray, start: np.ndarray, stop: np.ndarray, blocks: int) -> list[tuple[int, int, bytes]]:
    """Removed stretches as (row key, start, stop) by block of the row."""
    if not len(row):
        return []
    key = row_key(doc, row).view(np.uint64)
    return [
        (REPEATS, p, key[at].astype("<u8").tobytes() + packed_numbers(start[at], 4) + packed_numbers(stop[at], 4))
        for p, at in by_part(row % blocks)
    ]


def repeats_in(data: bytes) -> np.ndarray:
    """The (row key, start, stop) triples of one packet."""
    count = len(data) // 16
    key = np.frombuffer(data, "<i8", count)
    return np.stack([key, unpacked_numbers(data, 4, count, 8 * count).astype(np.int64), unpacked_numbers(data, 4, count, 12 * count).astype(np.int64)], axis=1)


@dataclass
class Solved:
    """Of one shard or several: the repeats (document, row, start, stop), the segments that other shards must be asked about (document, row, place, name, begin, length), and the text these begin in."""

    repeats: list[np.ndarray]
    segments: list[np.ndarray]
    text: np.ndarray


def solve(shard: Shard, window: int) -> Solved:
    """Step 2 for one shard."""
    text, doc, row, place, name, starts = shard.text, shard.doc, shard.row, shard.place, shard.name, shard.starts
    order = suffix_array(text)
    shared = common_prefixes(text, order, window)
    first = np.flatnonzero(np.concatenate([[True], shared[1:] < window]))
    owner = np.where(starts, doc, NO_ID)
    least = np.repeat(np.minimum.reduceat(owner[order], first), np.diff(np.append(first, len(order))))
    smallest = np.empty(len(order), np.int64)
    smallest[order] = least
    repeated = starts & (doc > smallest)
    a, b = stretches(repeated, row, place)
    repeats = [doc[a], row[a], place[a], place[b] + window]
    a, b = stretches(starts & ~repeated, row, place, name)
    return Solved(repeats, [doc[a], row[a], place[a], name[a], a, b - a + window], text)


def together(solved: list[Solved]) -> Solved:
    behind = np.cumsum([0, *(len(x.text) for x in solved)])
    for x, at in zip(solved, behind):
        x.segments[4] = x.segments[4] + at
    return Solved(
        [np.concatenate(x) for x in zip(*(x.repeats for x in solved))],
        [np.concatenate(x) for x in zip(*(x.segments for x in solved))],
        np.concatenate([x.text for x in solved]),
    )


def packet(doc: np.ndarray, row: np.ndarray, place: np.ndarray, begin: np.ndarray, n: np.ndarray, text: np.ndarray) -> bytes:
    """Segments of a text with their documents, rows and places there."""
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
    head = packed_numbers(doc.view(np.uint64), 8) + b"".join(packed_numbers(x, 4) for x in (row, place, n))
    return np.int64(len(n)).tobytes() + head + text[inside].tobytes()


def sharder(row: str, text: str, block: str, window: int, bits: int, parts: int, blocks: int, salts: int):
    """Step 2, for applyInArrow by block on documents and marks: shards of bounded size, solved one after the other, sent together."""

    def shards(docs: pa.Table, marks: pa.Table) -> pa.Table:
        found = list(pieces(docs, row, text, window))
        rows, solved = [], [solve(x, window) for x in shards_of(found, marked(found, marks, bits), window)] if found else []
        if solved:
            every = together(solved)
            rows = repeat_rows(*every.repeats, blocks)
            doc, digest, place, name, begin, n = every.segments
            for p, at in by_part((name % np.uint64(parts)).astype(np.int64)) if len(n) else ():
                rows.append((SEGMENTS, p, packet(doc[at], digest[at], place[at], begin[at], n[at], every.text)))
        salt = docs.column(block)[0].as_py() % salts if len(docs) else 0
        return sent(rows).add_column(2, "salt", pa.array([salt] * len(rows), pa.int32()))

    return hands_back(shards)


def window_digests(text: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """A digest of the window at each start, from the eight-byte words that cover it."""
    words = byte_words(text, "<u8")
    out = np.zeros(len(starts), np.uint64)
    for turn, place in enumerate([*range(0, window - 8, 8), window - 8]):
        word = words[starts + place]
        word ^= word >> np.uint64(32)
        out += word * ODD[turn % len(ODD)]
        if turn % len(ODD) == len(ODD) - 1:
            out = mixed(out)
    return mixed(out)


def merger(window: int, blocks: int, goes_on: bool):
    """Step 3, for applyInArrow by kind and part: repeats and, if the merge goes on, the segments that are left."""

    def merge(group: pa.Table) -> pa.Table:
        kind, part = group.column("kind")[0].as_py(), group.column("part")[0].as_py()
        data = [x.as_py() for x in group.column("data")]
        if kind == REPEATS:
            return sent([(REPEATS, part, one) for one in data])
        heads, texts = [], []
        for one in data:
            count = int(np.frombuffer(one, "<i8", 1)[0])
            doc = unpacked_numbers(one, 8, count, 8).view(np.int64)
            rest = [unpacked_numbers(one, 4, count, 8 + 8 * count + 4 * count * i).astype(np.int64) for i in range(3)]
            heads.append([doc, *rest])
            texts.append(np.frombuffer(one, np.uint8, offset=8 + 20 * count))
        (doc, row, place, n), text = (np.concatenate(x) for x in zip(*heads)), np.concatenate(texts)
        begin, windows = np.cumsum(n) - n, n - window + 1
        segment = np.repeat(np.arange(len(n), dtype=np.int32), windows)
        step = (np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)).astype(np.int32)
        digest = window_digests(text, begin[segment] + step, window)
        owner = doc[segment]
        order = np.argsort(digest)
        ordered = digest[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        known, least = ordered[first], np.minimum.reduceat(owner[order], first)
        # in order of the digests the search finds what it needs in the processor's cache
        repeated = np.empty(len(digest), bool)
        repeated[order] = owner[order] > least[np.searchsorted(known, ordered)]
        del order, ordered, first, known
        # windows of one segment are neighbours in its text; a stretch of them is a segment again
        a, b = segment_stretches(repeated, segment)
        of = segment[a]
        rows = repeat_rows(doc[of], row[of], place[of] + step[a], place[of] + step[b] + window, blocks)
        if goes_on and not repeated.all():
            a, b = segment_stretches(~repeated, segment)
            of = segment[a]
            rows.append((SEGMENTS, part, packet(doc[of], row[of], place[of] + step[a], begin[of] + step[a], b - a + window, text)))
        return sent(rows)

    return merge


def union_of(stretch: np.ndarray) -> np.ndarray:
    """Stretches (start, stop) joined where they touch."""
    stretch = stretch[np.argsort(stretch[:, 0], kind="stable")]
    reach = np.maximum.accumulate(stretch[:, 1])
    first = np.flatnonzero(np.concatenate([[True], stretch[1:, 0] > reach[:-1]]))
    return np.stack([stretch[first, 0], reach[np.append(first[1:], len(stretch)) - 1]], axis=1)


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def cutter(columns: list[str], names: list[str], row: str):
    """Step 4, for applyInArrow on a block's documents and repeats: the input columns, kept bytes, removed spans (under ``names``)."""

    def cut(docs: pa.Table, repeats: pa.Table) -> pa.Table:
        found = np.concatenate([np.zeros((0, 3), np.int64), *(repeats_in(x.as_py()) for x in repeats.column("data"))])
        found = found[np.argsort(found[:, 0], kind="stable")]
        ids = found[:, 0]
        kept, spans = [], []
        doc = doc_numbers(docs)
        keys = row_key(doc, docs.column(row).to_numpy()) if len(doc) else doc
        for a, b, text in zip(np.searchsorted(ids, keys, "left").tolist(), np.searchsorted(ids, keys, "right").tolist(), docs.column(names[0])):
            data = text.as_py()
            gone = union_of(found[a:b, 1:]).tolist() if b > a else []
            edges = [0, *(x for pair in gone for x in pair), len(data)]
            kept.append(b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)) if gone else data)
            spans.append([{"start": s, "stop": e} for s, e in gone])
        out = docs.select(columns)
        return out.append_column(names[1], pa.array(kept, pa.binary())).append_column(names[2], pa.array(spans, SPANS))

    return cut


def added_names(docs: DataFrame) -> list[str]:
    """The names under which ``remove_repeats`` adds bytes, kept bytes and spans: ``_bytes``, ``_kept``, ``_spans``, or more underscores in front."""
    return free_names(docs.columns, "_bytes", "_kept", "_spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW, shards: int = SHARDS) -> DataFrame:
    """All rows of ``docs``, with ``text`` replaced by its bytes, those left and the maximal removed runs, named by ``added_names``."""
    if window < GRAM:
        raise ValueError(f"windows need {GRAM} bytes at least")
    total = text_bytes(docs)
    parts = max(16, int(total // PART_BYTES))
    blocks = max(16, min(SMALL, parts), int(total // BLOCK_BYTES))
    bits = min(20, max(4, int(total // NAME_PART_BYTES).bit_length()))
    added = added_names(docs)
    row_name, block_name = free_names([*docs.columns, *added], "_row", "_block")
    carried = docs.withColumn(added[0], F.coalesce(F.col("text").cast("binary"), F.lit(b""))).drop("text")
    row = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), added[0]), F.lit(1 << 32))
    # one shuffle of the documents, read three times
    dealt = carried.withColumn(row_name, row).withColumn(block_name, F.pmod(row_name, F.lit(blocks)).cast("int")).groupBy(block_name)

    named = dealt.applyInArrow(namer(row_name, added[0], block_name, window, bits), NAMES)
    marks = named.groupBy("part").applyInArrow(mark, MARKS)
    salts = max(1, -(-int(total) // (SHARD_BYTES * shards)))
    asked = dealt.cogroup(marks.groupBy("block")).applyInArrow(sharder(row_name, added[0], block_name, window, bits, parts, blocks, salts), SENT)
    left = "kind int, part int, data binary"
    if salts > 1:
        asked = asked.groupBy("kind", "part", "salt").applyInArrow(merger(window, blocks, True), left)
    found = asked.groupBy("kind", "part").applyInArrow(merger(window, blocks, False), left).drop("kind")
    out = T.StructType([*carried.schema.fields, T.StructField(added[1], T.BinaryType()), T.StructField(added[2], T.ArrayType(SPAN))])
    return dealt.cogroup(found.groupBy("part")).applyInArrow(cutter(carried.columns, added, row_name), out)
