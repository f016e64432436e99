"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A seed is an n-gram of a test item's words that is rare in the corpus, compared
with the item's other n-grams. In each document a frequent n-gram is a seed as well
if the words around it leave the least score possible, so a passage is found however
often the same edit of it leaked. An alignment of the least score matches so many of an
item's words that some are among its rarest ones, so a document is only compared with
items of which it has enough rare words; an n-gram that very many items share does not
bring each of them to each document. Where a document holds a seed, the words around it are aligned locally with the
whole item; the score is the best alignment's (matches minus mismatches and gaps)
over the number of the item's words, so it is 1 for a verbatim copy and falls
with every edit. Words are runs of letters and digits in lower case.

Test items are taken in blocks of bounded size; each block is one pass over all
documents, with the block's n-grams broadcast. Null and empty texts and items
without words meet nothing; items shorter than an n-gram are one seed as a whole.
Rows that repeat a doc_id or an item_id are pooled, the best score counts. Null
doc_ids and item_ids are carried along. Only doc_id, text and item_id, text are
read; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import text_of

GRAM = 3
MIN_SCORE = 0.5
#: An n-gram is rare if it is in at most so many times the documents of the item's median n-gram.
RARE_FACTOR = 4
#: Words of test items that one pass looks for; more items take more passes.
BLOCK_WORDS = 500_000
#: Cells of the alignment table that are filled at a time.
CELLS = 2_000_000
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class ItemBlock:
    """Items as arrays of word numbers (from 1), and where each n-gram stands in them."""

    item_ids: list
    items: list[np.ndarray]
    numbers: dict[str, int]

    def __post_init__(self):
        self.base = len(self.numbers) + 1
        grams, owners, places = [], [], []
        for owner, item in enumerate(self.items):
            codes = self.codes(item, min(GRAM, len(item)))
            grams.append(codes)
            owners.append(np.full(len(codes), owner))
            places.append(np.arange(len(codes)))
        self.gram = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        self.place = np.concatenate(places) if places else np.zeros(0, np.int64)
        self.grams = np.unique(self.gram)
        self.sizes = sorted({min(GRAM, len(i)) for i in self.items})

    def codes(self, numbers: np.ndarray, size: int) -> np.ndarray:
        """A number for each n-gram; 0 where a word is in no item."""
        if len(numbers) < size or not size:
            return np.zeros(0, np.uint64)
        n = len(numbers) - size + 1
        out, all_known = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(size):
            part = numbers[k : k + n].astype(np.uint64)
            all_known &= part > 0
            out = out * np.uint64(self.base) + part
        return np.where(all_known, out, np.uint64(0))

    def read(self, text: str) -> np.ndarray:
        found = words(text)
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in found), np.int64, len(found))

    def hits(self, numbers: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the document and in ``grams`` (sorted) of the n-grams found."""
        places, which = [], []
        for size in self.sizes:
            codes = self.codes(numbers, size)
            known = np.flatnonzero(codes)
            if len(known):
                at = np.minimum(np.searchsorted(grams, codes[known]), len(grams) - 1)
                same = grams[at] == codes[known]
                places.append(known[same])
                which.append(at[same])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(which)


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[ItemBlock]:
    """Reads the test items one partition at a time and groups them to blocks of about ``block_words`` words."""
    ids, arrays, numbers, total = [], [], {}, 0
    for row in items.select("item_id", text_of().alias("t")).toLocalIterator():
        found = words(row["t"])
        if not found:
            continue
        ids.append(row["item_id"])
        arrays.append(np.array([numbers.setdefault(w, len(numbers) + 1) for w in found]))
        total += len(found)
        if total >= block_words:
            yield ItemBlock(ids, arrays, numbers)
            ids, arrays, numbers, total = [], [], {}, 0
    if ids:
        yield ItemBlock(ids, arrays, numbers)


def gram_frequencies(docs: DataFrame, block: ItemBlock) -> np.ndarray:
    """Number of documents that hold each n-gram of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = shared.value
        total = np.zeros(len(block.grams), np.int64)
        for frame in frames:
            for text in frame["t"]:
                _, which = block.hits(block.read(text), block.grams)
                total[np.unique(which)] += 1
        gram = np.flatnonzero(total)
        yield pd.DataFrame({"gram": gram, "n": total[gram]})

    rows = docs.select(text_of().alias("t")).mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = rows.toPandas()  # at most one row per n-gram of the block
    out = np.zeros(len(block.grams), np.int64)
    out[found["gram"]] = found["n"]
    return out


def rare_grams(block: ItemBlock, frequency: np.ndarray, factor: float = RARE_FACTOR) -> np.ndarray:
    """True for each entry of the block's n-gram list that is a seed of its item in any document."""
    per_entry = frequency[np.searchsorted(block.grams, block.gram)]
    out = np.zeros(len(per_entry), bool)
    for owner in range(len(block.items)):
        mine = block.owner == owner if len(block.items) < 2 else slice(*np.searchsorted(block.owner, [owner, owner + 1]))
        values = per_entry[mine]
        out[mine] = values <= factor * max(1.0, float(np.median(values)))
    return out


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """Best local alignment of each item with its window: +1 a match, -1 a mismatch or a gap. Returns score and end in the window."""
    out = np.zeros((len(items), 2), np.int64)
    order = sorted(range(len(items)), key=lambda i: (len(windows[i]), len(items[i])))
    at = 0
    while at < len(order):
        n = max(1, min(len(order) - at, CELLS // max(1, len(windows[order[-1]]))))
        group = order[at : at + n]
        at += n
        width, height = max(len(windows[g]) for g in group), max(len(items[g]) for g in group)
        text = np.zeros((len(group), width), np.int64)
        item = np.full((len(group), height), -1, np.int64)
        for row, g in enumerate(group):
            text[row, : len(windows[g])] = windows[g]
            item[row, : len(items[g])] = items[g]
        step = np.arange(width)
        above = np.zeros((len(group), width + 1), np.int64)
        best, end = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for k in range(height):
            same = text == item[:, k : k + 1]
            cell = np.maximum(above[:, :-1] + np.where(same, 1, -1), above[:, 1:] - 1)
            cell = np.maximum(cell, 0)
            # a gap in the item: the best cell to the left, less one per step
            cell = np.maximum.accumulate(cell + step, axis=1) - step
            above[:, 1:] = cell
            place = cell.argmax(axis=1)
            top = cell[np.arange(len(group)), place]
            better = top > best
            best[better], end[better] = top[better], place[better]
        out[group, 0], out[group, 1] = best, end
    return out


def may_reach(
    block: ItemBlock, numbers: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, sure: np.ndarray, min_score: float, member: np.ndarray
) -> np.ndarray:
    """Which windows, sorted by item, are sure or hold enough words of the item for the least score: each match takes one.

    ``member`` is a place per word number, all False before and after.
    """
    out = sure.copy()
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(owner))):
        if sure[a:b].all():
            continue
        item = block.items[owner[a]]
        member[item] = True
        held = np.concatenate([[0], np.cumsum(member[numbers])])
        member[item] = False
        inside = held[np.clip(high[a:b], 0, len(numbers))] - held[np.clip(low[a:b], 0, len(numbers))]
        out[a:b] |= inside >= min_score * len(item)
    return out


@dataclass
class RareWords:
    """For each word, the items that have it among their rarest ones, and how many of these an alignment must match.

    An alignment of the least score matches ``least`` words of an item, so of any
    ``len - least + k`` words at least k. Words are the rarer, the fewer items have them.
    """

    first: np.ndarray  # per word, its first entry, and one past the last
    owner: np.ndarray
    times: np.ndarray
    need: np.ndarray  # per item: k

    def candidates(self, numbers: np.ndarray) -> np.ndarray:
        """Items, in order, of which a document with these words has enough rare words."""
        known = np.unique(numbers)
        known = known[known > 0]
        begin, count = self.first[known], self.first[known + 1] - self.first[known]
        entry = expanded(begin, count)
        owner, inverse = np.unique(self.owner[entry], return_inverse=True)
        held = np.bincount(inverse, weights=self.times[entry], minlength=len(owner))
        return owner[held >= self.need[owner]]


def expanded(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers from each ``begin`` on, ``count`` of them."""
    return np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def rare_words(block: ItemBlock, min_score: float) -> RareWords:
    holders = np.bincount(np.concatenate([np.unique(i) for i in block.items]), minlength=block.base)
    words, owners, times, need = [], [], [], []
    for owner, item in enumerate(block.items):
        least = max(1, int(np.ceil(min_score * len(item))))
        need.append(max(1, least // 4))
        rarest = item[np.argsort(holders[item], kind="stable")][: len(item) - least + need[-1]]
        word, n = np.unique(rarest, return_counts=True)
        words.append(word)
        owners.append(np.full(len(word), owner))
        times.append(n)
    word = np.concatenate(words)
    order = np.argsort(word, kind="stable")
    first = np.searchsorted(word[order], np.arange(block.base + 1))
    return RareWords(first, np.concatenate(owners)[order], np.concatenate(times)[order], np.array(need))


def entries_of(which: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray, keys: np.ndarray, candidates: np.ndarray, n_items: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the hit n-grams that belong to a candidate, and the hit of each; the shorter of both lists is gone through."""
    repeat = ends[which] - starts[which]
    if repeat.sum() <= len(which) * len(candidates):
        entry = expanded(starts[which], repeat)
        hit = np.repeat(np.arange(len(which)), repeat)
        at = np.minimum(np.searchsorted(candidates, owners[entry]), len(candidates) - 1)
        use = candidates[at] == owners[entry]
        return entry[use], hit[use]
    wanted = (which[:, None] * n_items + candidates[None, :]).ravel()
    begin = np.searchsorted(keys, wanted, "left")
    count = np.searchsorted(keys, wanted, "right") - begin
    return expanded(begin, count), np.repeat(np.repeat(np.arange(len(which)), len(candidates)), count)


def matches(docs: DataFrame, block: ItemBlock, rare: np.ndarray, min_score: float) -> DataFrame:
    """doc_id, item (place in the block), score, last_word of the aligned passages."""
    order = np.argsort(block.gram, kind="stable")
    rarest = rare_words(block, min_score)
    shared = docs.sparkSession.sparkContext.broadcast((block, rarest, block.gram[order], block.owner[order], block.place[order], rare[order]))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, rarest, grams, owners, places, rare = shared.value
        starts, ends = np.searchsorted(grams, block.grams, "left"), np.searchsorted(grams, block.grams, "right")
        lengths = np.array([len(i) for i in block.items])
        # entries stand by n-gram, then item
        keys = np.repeat(np.arange(len(block.grams)), ends - starts) * len(lengths) + owners
        member = np.zeros(block.base, bool)
        for frame in frames:
            found: list[tuple] = []
            for doc_id, text in zip(frame["doc_id"], frame["t"]):
                numbers = block.read(text)
                at, which = block.hits(numbers, block.grams)
                if not len(at):
                    continue
                candidates = rarest.candidates(numbers)
                if not len(candidates):
                    continue
                entry, hit = entries_of(which, starts, ends, owners, keys, candidates, len(lengths))
                owner, begin = owners[entry], at[hit] - places[entry]
                slack = lengths[owner] // 2 + 2
                low, high = begin - slack, begin + lengths[owner] + slack
                by = np.lexsort((low, owner))
                owner, low, high = owner[by], low[by], high[by]
                use = may_reach(block, numbers, owner, low, high, rare[entry][by], min_score, member)
                if not use.any():
                    continue
                owner, low, high = owner[use], low[use], high[use]
                # overlapping windows of one item become one
                reach = np.maximum.accumulate(high + owner * (len(numbers) * 4 + 100_000)) - owner * (len(numbers) * 4 + 100_000)
                new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (low[1:] > reach[:-1])])
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(new)]]) - 1
                for o, a, b in zip(owner[first], low[first], reach[last]):
                    a = max(0, int(a))
                    found.append((doc_id, int(o), a, numbers[a : int(b)]))
            got = align([block.items[o] for _, o, _, _ in found], [w for *_, w in found])
            rows = [
                (doc_id, o, score / lengths[o], a + end)
                for (doc_id, o, a, _), (score, end) in zip(found, got.tolist()) if score >= min_score * lengths[o]
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "item", "score", "last_word"])

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("t"))  # text keeps null and large ids whole
    rows = texts.mapInPandas(search, "doc_id string, item int, score double, last_word long")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, score, last_word: every document and test item that align to ``min_score`` or more, once each.

    ``last_word`` is the place in the document where the best alignment ends.
    """
    spark, parts = docs.sparkSession, []
    for block in item_blocks(benchmark, block_words):
        rare = rare_grams(block, gram_frequencies(docs, block))
        names = spark.createDataFrame([(i, v) for i, v in enumerate(block.item_ids)], "item int, item_id bigint")
        parts.append(matches(docs, block, rare, min_score).join(F.broadcast(names), "item"))  # at most block_words rows
    if not parts:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, score double, last_word bigint")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    best = F.max(F.struct("score", F.negative("last_word").alias("before"))).alias("best")
    return rows.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.score").alias("score"), F.negative("best.before").alias("last_word")
    )
