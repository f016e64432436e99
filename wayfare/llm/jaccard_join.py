"""Similarity join of word n-gram sets by vertical partitioning.

All n-grams stand in one global order: those of one document alone, then the
others by digest, then those that very many documents share. A document's set is
cut along this order into fragments; overlaps are counted fragment by fragment,
for the pairs that may be similar, and summed per pair. A pair may be similar only
if the leading parts of both sets, a quarter, have an n-gram in common, and early
enough in both; n-grams of one document have no partner and fill most leading
parts, so few documents are left to compare.

Documents with equal sets form one class from the start, and classes that are
known to hang together are not compared again, so groups of copies cost by their
size and not by its square; still no link between different classes is left out:

1. one pass gives each document's set size and class, the n-grams that are
   frequent in blocks of documents, and marks in a bitmap of bounded size the
   n-grams that two documents may share (all of them, when the bitmap is small
   for the data: the order stays a right one, with more to compare);
2. one pass sends the leading n-grams of each class that are shared to their
   lists; entries that have no other class of fitting size in their list go, if
   the list is in one piece (a partner may stand in another piece);
3. one pass brings parity signatures of the classes that are left;
4. each list proposes links between near neighbours and with its first class, of which
   the signatures rule out most; one pass brings the sets of the classes in the others,
   these are counted, and components built;
5. each list proposes all pairs across components that sizes and places in the
   order cannot rule out; these go the same way. A list is compared in pieces by the
   number of entries that it really has.

Tables in between are removed as soon as nothing reads them.

Words are runs of other characters than white space, A-Z in lower case; a text
with fewer words than an n-gram is one n-gram as a whole. Null and empty texts
have an empty set and are linked with nothing, not even each other. Repeated rows
give repeated results. A null doc_id takes part, but names a component only where
there is no other (as null). N-grams and sets are told apart by 64-bit digests.
Only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import drop_stored, hands_back, mixed, packed_numbers, stored, text_bytes, text_of, unpacked_numbers
from wayfare.llm.components import connected_components

GRAM = 5
PERCENT = 75
FRAGMENTS = 4
#: N-grams per block in which frequent ones are looked for, and how often they must be in it.
BLOCK_GRAMS = 1_000_000
FREQUENT_IN_BLOCK = 3
FREQUENT = 16
#: Frequent n-grams that are broadcast, the most frequent first; the order is right with any choice.
MAX_FREQUENT = 200_000
#: Documents of a frequent n-gram after which its list is split, and entries that are compared with each other at a time.
LIST_ENTRIES = 20_000
CHUNK = 2_000
PART_ENTRIES = 250_000
#: Entries after it in its list to which an entry's class is proposed as a link; what that leaves apart is compared in full.
NEIGHBOURS = 8
#: Places of the bitmap that tells which documents' sets are needed.
BITMAP_BITS = 1 << 24
#: 64-bit words of the shortest and the longest signature.
LEAST_SIGNATURE = 4
LONGEST_SIGNATURE = 2048
BLOCK_TEXT = 1 << 20
BLOCK_BYTES = 16 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
SALT = np.uint64(0xC2B2AE3D27D4EB4F)
ENTRY = np.dtype([("gram", "<u8"), ("cid", "<i8"), ("n", "<i4"), ("at", "<i4")])
#: Bits of a place in the bitmap of shared n-grams: one place per four bytes of text, at least 2^22 and at most 2^28 (32 MB).
LEAST_SHARED_BITS, MOST_SHARED_BITS = 22, 28
#: Entries that are packed at a time, and pairs that are held before repeated ones go.
FLUSH_ENTRIES = 300_000
HELD_PAIRS = 500_000
#: Bytes of text per part in which n-grams are counted for it.
GRAM_PART_BYTES = 8 << 20


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and the text's bytes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("t"))


def text_digest(text: Column) -> Column:
    """By which ``component_rows`` tells apart texts with one doc_id; null counts as empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


class Powers:
    """Powers of an odd number and of its inverse, as many as the longest block needed so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = np.uint64(len(self.up))
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(int(STEP), int(size), 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(int(STEP), -int(size), 1 << 64))])
        return self.up[:n], self.down[:n]


POWERS = Powers()
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: A digest of each byte, the same for both cases of a letter from A to Z.
BYTE = mixed(np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint64) + SALT)


def word_digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the words of all texts, in order, and where each text's words end.

    A word's digest is a sum of its bytes' digests times powers of its places, taken
    from running sums over the whole block.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    up, down = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * up[: len(data)], out=sums[1:])
    space = np.concatenate([[True], IS_SPACE[data], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[0::2], edges[1::2]
    words = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    stops = np.cumsum([len(t) + 1 for t in texts])
    return words, np.searchsorted(starts, stops)


def gram_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct n-gram digests of each text."""
    words, ends = word_digests(texts)
    rolled = words[: max(len(words) - size + 1, 0)].copy()
    for k in range(1, size):
        rolled = rolled * STEP + words[k : len(words) - size + 1 + k]
    rolled = mixed(rolled)
    out = []
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = b - a
            for value in words[a:b].tolist():
                whole = (whole * int(STEP) + value) & 0xFFFFFFFFFFFFFFFF
            out.append(mixed(np.array([whole], np.uint64)))
        else:
            out.append(words[:0])
    return out


def class_id(grams: np.ndarray) -> int:
    """A digest of a set, as a signed number."""
    total = (int(mixed(grams ^ SALT).sum(dtype=np.uint64)) + len(grams) * int(STEP)) & 0xFFFFFFFFFFFFFFFF
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def rows_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and n-gram set of each row, worked out in blocks of about BLOCK_TEXT bytes."""
    for batch in batches:
        ids, texts, total = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text.as_py())
            total += len(texts[-1])
            if total >= BLOCK_TEXT:
                yield from zip(ids, gram_sets(texts, size))
                ids, texts, total = [], [], 0
        if ids:
            yield from zip(ids, gram_sets(texts, size))


def digested_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``rows_of`` with the digest in the third column."""
    for batch in batches:
        for digest, (doc_id, grams) in zip(batch.column(2).to_pylist(), rows_of(iter([batch]), size)):
            yield doc_id, digest, grams


def summarise(size: int, part_bits: int):
    """Pass 1, for mapInArrow: rows per document (kind 0), of n-grams frequent in a block (1), and of all n-grams (2)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, held, total = [], [], 0
        for doc_id, digest, grams in digested_rows(batches, size):
            docs.append((doc_id, len(grams), class_id(grams) if len(grams) else None, digest))
            held.append(grams)
            total += len(grams)
            if total >= BLOCK_GRAMS:
                yield summary(docs, held, part_bits)
                docs, held, total = [], [], 0
        yield summary(docs, held, part_bits)

    return hands_back(blocks)


SUMMARY = "kind int, id bigint, n bigint, cid bigint, digest bigint, places binary"


def summary(docs: list[tuple], held: list[np.ndarray], part_bits: int) -> pa.RecordBatch:
    grams, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    # cut to 32 bits in parts of their range; an n-gram that two documents of the block have is sent twice
    twice = np.repeat(grams, np.minimum(counts, 2))
    part = (twice >> np.uint64(64 - part_bits)).astype(np.int64)
    inside = ((twice << np.uint64(part_bits)) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    blobs = [packed(inside[a:b]) for a, b in zip(starts, np.append(starts[1:], len(part)))]
    often = counts >= FREQUENT_IN_BLOCK
    grams, counts = grams[often].view(np.int64), counts[often]
    ids, sizes, cids, digests = (list(x) for x in zip(*docs)) if docs else ([], [], [], [])
    n_docs, n_often, n_parts = len(docs), len(grams), len(blobs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([0] * n_docs + [1] * n_often + [2] * n_parts, pa.int32()),
            pa.array(ids + grams.tolist() + part[starts].tolist(), pa.int64()),
            pa.array(sizes + counts.tolist() + [None] * n_parts, pa.int64()),
            pa.array(cids + [None] * (n_often + n_parts), pa.int64()),
            pa.array(digests + [None] * (n_often + n_parts), pa.int64()),
            pa.array([None] * (n_docs + n_often) + blobs, pa.binary()),
        ],
        names=["kind", "id", "n", "cid", "digest", "places"],
    )


def packed(places: np.ndarray) -> bytes:
    """Sorted places, as steps."""
    return packed_numbers(np.diff(places, prepend=0), 4)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked_numbers(data, 4, len(data) // 4), dtype=np.int64)


def marker(part_bits: int, shared_bits: int):
    """For applyInArrow by part: the part's slice of the bitmap, with the places of n-grams that were sent twice."""

    def mark(group: pa.Table) -> pa.Table:
        found = np.sort(np.concatenate([unpacked(x.as_py()) for x in group.column("places")]))
        twice = found[1:][found[1:] == found[:-1]]
        slots = np.zeros(1 << (shared_bits - part_bits), np.uint8)
        slots[twice >> (32 - shared_bits + part_bits)] = 1
        part = group.column("id")[0].as_py()
        return pa.table({"part": pa.array([part], pa.int64()), "bits": pa.array([np.packbits(slots, bitorder="little").tobytes()], pa.binary())})

    return mark


class Frequent:
    """Frequent n-grams: membership, place at the end of the global order, and number of sub-lists."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        by = np.argsort(grams)
        self.grams, self.counts = grams[by], counts[by]
        order = np.lexsort((self.grams, self.counts))
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.hint = np.zeros(1 << 20, bool)
        self.hint[(self.grams >> np.uint64(44)).astype(np.int64)] = True

    def places(self, grams: np.ndarray) -> np.ndarray:
        """Place of each n-gram in the list, -1 for ordinary ones."""
        out = np.full(len(grams), -1, np.int64)
        maybe = np.flatnonzero(self.hint[(grams >> np.uint64(44)).astype(np.int64)]) if len(self.grams) else []
        if len(maybe):
            at = np.minimum(np.searchsorted(self.grams, grams[maybe]), len(self.grams) - 1)
            same = self.grams[at] == grams[maybe]
            out[maybe[same]] = at[same]
        return out

    def pieces(self, place: np.ndarray, entries: int) -> np.ndarray:
        """Number of pieces of about ``entries`` documents for the n-grams at these places of the list; 1 for ordinary ones."""
        out = np.ones(len(place), np.int64)
        out[place >= 0] = -(-self.counts[place[place >= 0]] // entries)
        return out


def leading(size: int, percent: int) -> int:
    """N-grams of which two similar sets must share one: all but those that the overlap can do without, and one more."""
    return size - -(-percent * size // 100) + 1


def lister(frequent_shared, bitmap_shared, shared_bits: int, size: int, percent: int, bits: int, list_entries: int):
    """Pass 2, for mapInArrow: the shared n-grams of each class's leading part, packed by part of the n-grams' range."""

    def flush(held: list[tuple[np.ndarray, int, int, int]], frequent: Frequent) -> pa.RecordBatch:
        lengths = [len(grams) for grams, *_ in held]
        entries = np.zeros(sum(lengths), ENTRY)
        entries["gram"] = np.concatenate([grams for grams, *_ in held])
        entries["cid"], entries["n"], start = (np.repeat([h[i] for h in held], lengths) for i in (1, 2, 3))
        entries["at"] = start + np.concatenate([np.arange(n) for n in lengths])
        spread = entries["gram"].copy()
        place = frequent.places(spread)
        heavy = np.flatnonzero(place >= 0)
        salts = frequent.pieces(place[heavy], list_entries)
        salt = entries["cid"][heavy] % salts
        spread[heavy] = np.where(salts > 1, mixed(spread[heavy] + salt.astype(np.uint64) * SALT), spread[heavy])
        part = (spread >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        entries, part = entries[order], part[order]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        blobs = [entries[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(part)))]
        return pa.RecordBatch.from_arrays([pa.array(part[starts], pa.int32()), pa.array(blobs, pa.binary())], names=["part", "entries"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, bitmap = Frequent(*frequent_shared.value), np.frombuffer(bitmap_shared.value, np.uint8)
        seen: set[int] = set()
        held, total = [], 0
        for _, grams in rows_of(batches, size):
            place = (grams >> np.uint64(64 - shared_bits)).astype(np.int64)
            common = grams[bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1]
            alone = len(grams) - len(common)
            want = leading(len(grams), percent) - alone if len(grams) else 0
            if want <= 0:
                continue
            cid = class_id(grams)
            if cid in seen:
                continue
            seen.add(cid)
            place = frequent.places(common)
            first = common[place < 0][:want]
            if len(first) < want:
                late = np.flatnonzero(place >= 0)
                late = late[np.argsort(frequent.rank[place[late]])][: want - len(first)]
                first = np.concatenate([first, common[late]])
            held.append((first, cid, len(grams), alone))
            total += len(first)
            if total >= FLUSH_ENTRIES:
                yield flush(held, frequent)
                held, total = [], 0
        if held:
            yield flush(held, frequent)

    return hands_back(lists)


def possible(na: np.ndarray, nb: np.ndarray, ia: np.ndarray, ib: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar if the first n-gram they share stands at these places."""
    need = -(-percent * (na + nb) // (100 + percent))
    return (na - ia >= need) & (nb - ib >= need)


LISTED = "kind int, gram bigint, a bigint, na int, at int, b bigint, nb int"


def matcher(frequent_shared, percent: int, list_entries: int):
    """For applyInPandas by part: entries (kind 0) that may have another class of fitting size, and proposed links (kind 1).

    All entries of a split list stay: sub-lists meet only when they are compared in full.
    """

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        frequent = Frequent(*frequent_shared.value)
        entries = np.unique(np.frombuffer(b"".join(frame["entries"]), ENTRY))  # by gram, class, size
        entries = entries[np.lexsort((entries["cid"], entries["n"], entries["gram"]))]
        gram, cid, n, at = entries["gram"], entries["cid"], entries["n"].astype(np.int64), entries["at"].astype(np.int64)
        fits = (gram[1:] == gram[:-1]) & (100 * n[:-1] >= percent * n[1:])
        place = frequent.places(gram)
        keep = np.concatenate([fits, [False]]) | np.concatenate([[False], fits]) | (frequent.pieces(place, list_entries) > 1)
        gram, cid, n, at = gram[keep], cid[keep], n[keep], at[keep]
        if not len(gram):
            return pd.DataFrame({c.split()[0]: [] for c in LISTED.split(", ")})
        first = np.concatenate([[True], gram[1:] != gram[:-1]])
        hub = np.maximum.accumulate(np.where(first, np.arange(len(gram)), 0))
        here = np.arange(len(gram))
        left = np.concatenate([hub, *(here[: max(len(gram) - k, 0)] for k in range(1, NEIGHBOURS + 1))])
        right = np.concatenate([here, *(here[k:] for k in range(1, NEIGHBOURS + 1))])
        use = (gram[left] == gram[right]) & (left != right) & possible(n[left], n[right], at[left], at[right], percent)
        left, right = left[use], right[use]
        pairs = np.unique(np.stack([cid[left], n[left], cid[right], n[right]], axis=1), axis=0)
        rows = pd.DataFrame({"kind": 0, "gram": gram.view(np.int64), "a": cid, "na": n, "at": at, "b": 0, "nb": 0})
        proposed = pd.DataFrame({"kind": 1, "gram": 0, "a": pairs[:, 0], "na": pairs[:, 1], "at": 0, "b": pairs[:, 2], "nb": pairs[:, 3]})
        return pd.concat([rows, proposed], ignore_index=True)

    return hands_back(match)


def signature(grams: np.ndarray, words: int) -> np.ndarray:
    """Parity of the set's members per place; two signatures differ in no more places than the sets have members apart."""
    places = np.bincount((grams >> np.uint64(13)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(places.astype(np.uint8)).view(np.uint64)


def long_signature(grams: np.ndarray) -> np.ndarray:
    """A signature of four places or more per member."""
    words = LEAST_SIGNATURE
    while 16 * words < len(grams) and words < LONGEST_SIGNATURE:
        words *= 2
    return signature(grams, words)


def apart_at_least(a: np.ndarray, b: np.ndarray) -> int:
    """Places in which two signatures differ; the longer one is folded to the size of the other."""
    size = min(len(a), len(b))
    fold = lambda x: np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)
    return int(np.bitwise_count(fold(a) ^ fold(b)).sum())


def by_class(shared, size: int, fragments: int):
    """For mapInArrow over documents whose place in the bitmap is set: signatures (no fragments) or sets cut into fragments of the order."""

    def rows_per_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bitmap(shared)(batches):
            rows: list[tuple] = []
            for _, grams in rows_of(iter([batch.select([0, 1])]), size):
                if not len(grams):
                    continue
                cid = class_id(grams)
                if not fragments:
                    rows.append((cid, 0, long_signature(grams).tobytes()))
                else:
                    cuts = np.searchsorted(grams, [np.uint64(((1 << 64) * f) // fragments) for f in range(1, fragments)])
                    rows += [(cid, fragment, held.tobytes()) for fragment, held in enumerate(np.split(grams, cuts))]
                if len(rows) > 2000:
                    yield class_batch(rows)
                    rows = []
            yield class_batch(rows)

    return hands_back(rows_per_class)


PER_CLASS = "cid bigint, fragment int, data binary"


def class_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 3
    types = [pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["cid", "fragment", "data"])


def of_classes(texts: DataFrame, classes: DataFrame, wanted: DataFrame, size: int, fragments: int, label: str) -> DataFrame:
    """cid, fragment, data of the classes in ``wanted`` (cid), from the text of each class's first document.

    A bitmap of first documents tells whose texts are read; a document that shares
    its place in it brings a class that is not wanted, or one that is there already.
    """
    wanted = stored(wanted.select("cid").distinct(), "wanted")
    shared = texts.sparkSession.sparkContext.broadcast(bitmap_of(wanted.join(classes, "cid").select(F.col("first").alias("id"))))
    near = texts.withColumn("place", place_of("doc_id")).mapInArrow(by_class(shared, size, fragments), PER_CLASS)
    out = stored(near.join(wanted, "cid", "left_semi").dropDuplicates(["cid", "fragment"]), label)
    shared.destroy()
    drop_stored(wanted)
    return out


def not_ruled_out(percent: int):
    """For mapInPandas: pairs with both signatures to the pairs that may be similar."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for na, nb, a, b in zip(frame["na"], frame["nb"], frame["wa"], frame["wb"]):
                most = (na + nb - apart_at_least(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))) // 2
                keep.append(100 * most >= percent * (na + nb - most))
            yield frame.loc[keep, ["a", "na", "b", "nb"]]

    return check


def likely(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, na, b, nb) that the signatures leave."""
    left, right = marks.select(F.col("cid").alias("a"), F.col("data").alias("wa")), marks.select(F.col("cid").alias("b"), F.col("data").alias("wb"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(not_ruled_out(percent), "a bigint, na int, b bigint, nb int")


def count_fragment(key: tuple, pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """Partial overlaps of the pairs of one block in one fragment."""
    held = {cid: np.frombuffer(grams, np.uint64) for cid, grams in zip(sets["cid"], sets["data"])}
    none = np.zeros(0, np.uint64)
    found = [
        len(np.intersect1d(held.get(a, none), held.get(b, none), assume_unique=True)) for a, b in zip(pairs["a"], pairs["b"])
    ]
    return pd.DataFrame({"a": pairs["a"], "na": pairs["na"], "b": pairs["b"], "nb": pairs["nb"], "overlap": found})


def links_of(pairs: DataFrame, held: DataFrame, fragments: int, percent: int) -> DataFrame:
    """a, b of the pairs (a, na, b, nb) that are similar: overlaps per fragment, summed per pair.

    Classes are dealt to blocks; a set goes once to each pair of blocks in which it
    has a partner, so a class with many partners is sent ``blocks`` times at most.
    """
    blocks = max(4, -(-int(held.agg(F.sum(F.octet_length("data"))).first()[0] or 0) // BLOCK_BYTES))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    dealt = pairs.select("a", "na", "b", "nb", block("a").alias("p"), block("b").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))).alias("fragment"))
    needs = dealt.select("p", "q", "fragment", F.explode(F.array("a", "b")).alias("cid")).distinct()
    sent = needs.join(held, ["cid", "fragment"]).select(
        F.col("p").alias("sp"), F.col("q").alias("sq"), F.col("fragment").alias("sf"), "cid", "data"
    )
    partial = (
        dealt.groupBy("p", "q", "fragment").cogroup(sent.groupBy("sp", "sq", "sf"))
        .applyInPandas(count_fragment, "a bigint, na int, b bigint, nb int, overlap bigint")
    )
    whole = partial.groupBy("a", "na", "b", "nb").agg(F.sum("overlap").alias("overlap"))
    return whole.where(100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def crosser(percent: int):
    """For applyInPandas by part: pairs across components that sizes and places allow."""

    def cross(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["gram", "p", "q", "n", "cid"], ignore_index=True)
        n, cid, root, side, at = (frame[c].to_numpy(np.int64) for c in ("n", "cid", "root", "side", "at"))
        apart = frame["p"].to_numpy() != frame["q"].to_numpy()
        group = frame.groupby(["gram", "p", "q"], sort=False).ngroup().to_numpy()
        reach = np.searchsorted(group, group, "right")  # end of each entry's list
        found: list[np.ndarray] = []
        held = 0
        live = np.arange(len(frame))
        for offset in range(1, len(frame)):
            live = live[live + offset < reach[live]]
            # sizes rise within a list: once one does not fit, no later one does
            live = live[100 * n[live] >= percent * n[live + offset]]
            if not len(live):
                break
            other = live + offset
            ok = (root[live] != root[other]) & (~apart[live] | (side[live] != side[other]))
            ok &= possible(n[live], n[other], at[live], at[other], percent)
            a, b = live[ok], other[ok]
            if len(a):
                found.append(np.stack([cid[a], n[a], cid[b], n[b]], axis=1))
                held += len(a)
                if held > HELD_PAIRS:
                    found = [np.unique(np.concatenate(found), axis=0)]
                    held = min(len(found[0]), HELD_PAIRS // 2)
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "na": pairs[:, 1], "b": pairs[:, 2], "nb": pairs[:, 3]})

    return hands_back(cross)


def ordered_pairs(pairs: DataFrame) -> DataFrame:
    """Each pair once, the smaller class first."""
    swap = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return pairs.select(pick("a", "b").alias("a"), pick("na", "nb").alias("na"), pick("b", "a").alias("b"), pick("nb", "na").alias("nb")).distinct()


def cross_pairs(entries: DataFrame, roots: DataFrame, percent: int, chunk: int) -> DataFrame:
    """Pairs of classes in one list and different components; lists of more than ``chunk`` entries are compared chunk by chunk."""
    sizes = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > chunk)
    chunked = entries.join(sizes, "gram", "left").withColumn("chunks", F.coalesce(F.ceil(F.col("held") / chunk), F.lit(1)))
    rooted = chunked.join(roots, chunked["cid"] == roots["id"], "left").withColumn("root", F.coalesce("root", "cid"))
    mine = F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")
    sent = rooted.select("gram", "cid", "n", "at", "root", mine.alias("side"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("with"))
    parts = max(1, entries.count() // PART_ENTRIES)
    dealt = sent.select(
        "gram", "cid", "n", "at", "root", "side", F.least("side", "with").alias("p"), F.greatest("side", "with").alias("q")
    ).withColumn("part", F.pmod(F.xxhash64("gram", "p", "q"), F.lit(parts)))
    return dealt.groupBy("part").applyInPandas(crosser(percent), "a bigint, na int, b bigint, nb int")


def place_of(column: str):
    """Place of an id in a bitmap."""
    return F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS))


def in_bitmap(shared):
    """For mapInArrow: rows whose last column is a place that is set; others with the same place come along."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            place = batch.column(batch.num_columns - 1).to_numpy()
            yield batch.take(pa.array(np.flatnonzero(bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1)))

    return keep


def bitmap_of(ids: DataFrame) -> bytes:
    """A bitmap of fixed size with the places of the ids set; made by Spark in pieces of 4 KB."""
    pieces = ids.select(place_of("id").alias("x")).groupBy(F.floor(F.col("x") / 32768).alias("piece")).agg(
        F.bitmap_construct_agg((F.col("x") % 32768).cast("long")).alias("bits")
    )
    out = bytearray(BITMAP_BITS // 8)
    for row in pieces.collect():  # BITMAP_BITS / 32768 rows at most
        out[row["piece"] * 4096 : (row["piece"] + 1) * 4096] = row["bits"]
    return bytes(out)


def similar_components(
    docs: DataFrame, size: int = GRAM, percent: int = PERCENT, fragments: int = FRAGMENTS, list_entries: int = LIST_ENTRIES, chunk: int = CHUNK
) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that is reachable by links, its own included."""
    return component_rows(docs, size, percent, fragments, list_entries, chunk).select("doc_id", "n_shingles", "component_id")


def component_rows(
    docs: DataFrame, size: int = GRAM, percent: int = PERCENT, fragments: int = FRAGMENTS, list_entries: int = LIST_ENTRIES, chunk: int = CHUNK
) -> DataFrame:
    """``similar_components`` with component, a number of the component (null without words), and text_digest.

    doc_id and text_digest tell what row a row is about, also where a doc_id has several texts.
    """
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    texts = texts_of(docs)
    n_bytes = text_bytes(docs)
    part_bits = min(20, max(4, int(n_bytes // GRAM_PART_BYTES).bit_length()))
    shared_bits = min(MOST_SHARED_BITS, max(LEAST_SHARED_BITS, (n_bytes // 4).bit_length()))

    seen = stored(texts.withColumn("digest", F.xxhash64("t")).mapInArrow(summarise(size, part_bits), SUMMARY), "sets-seen")
    members = stored(seen.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "cid", "digest"), "members")
    classes = stored(members.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("first")), "classes")
    often = seen.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    top = often.orderBy(F.desc("n"), "id").limit(MAX_FREQUENT).toArrow()
    frequent = context.broadcast((top["id"].to_numpy().view(np.uint64), top["n"].to_numpy()))
    bitmap = bytearray((1 << shared_bits) // 8)
    length = len(bitmap) >> part_bits
    slices = seen.where("kind = 2").select("id", "places").groupBy("id").applyInArrow(marker(part_bits, shared_bits), "part bigint, bits binary")
    for part in slices.toLocalIterator():  # the bitmap, slice by slice
        bitmap[part["part"] * length : (part["part"] + 1) * length] = part["bits"]
    shared = context.broadcast(bitmap)
    del bitmap, top
    drop_stored(seen)

    entries_due = (members.agg(F.sum("n")).first()[0] or 0) * (100 - percent) // 100
    bits = max(4, int(entries_due // PART_ENTRIES).bit_length())
    leads = texts.mapInArrow(lister(frequent, shared, shared_bits, size, percent, bits, list_entries), "part int, entries binary")
    listed = stored(leads.groupBy("part").applyInPandas(matcher(frequent, percent, list_entries), LISTED), "lists")
    shared.destroy()
    frequent.destroy()
    entries = listed.where("kind = 0").select("gram", F.col("a").alias("cid"), F.col("na").alias("n"), "at")
    proposed = ordered_pairs(listed.where("kind = 1").select("a", "na", "b", "nb"))
    marks = of_classes(texts, classes, entries, size, 0, "marks")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of some pairs those that are similar."""
        checked = stored(likely(pairs, marks, percent), "pairs")
        asked = of_classes(texts, classes, checked.select(F.explode(F.array("a", "b")).alias("cid")), size, fragments, "sets")
        links = stored(links_of(checked, asked, fragments, percent), "links")
        drop_stored(checked, asked)
        return links

    links = linked(proposed)
    roots = connected_components(links)
    across = linked(ordered_pairs(cross_pairs(entries, roots, percent, chunk)))
    drop_stored(listed, marks, roots)
    roots = connected_components(links.union(across))
    drop_stored(links, across)

    rooted = classes.join(roots, classes["cid"] == roots["id"], "left").select("cid", "first", F.coalesce("root", "cid").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(heads, "root").select("cid", "root", "component_id"), "components")
    return members.join(named, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("root").alias("component"), F.col("digest").alias("text_digest"),
    )
