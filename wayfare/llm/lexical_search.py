"""Ranked lexical search of many items at once, with common subexpressions evaluated once.

A document's score for an item is a sum over the item's terms, so terms that several
items share can be summed once for all of them. Terms that stand in the same items
form an atom. Then, while two neighbours in the items' lists (in one order for all)
stand side by side in two items or more, the most frequent such pair becomes a node
of its own. The items' lists over atoms and nodes are a directed acyclic graph; each
batch of documents gets a row of partial sums per atom, then per node from its two
parts, and each item adds up what is left in its list. All numbers are integers, so
the order of addition does not change a score.

Items are taken in blocks of bounded size; each block is one pass over the texts that
stores the documents' counts of the block's terms, and one over these counts. A task
keeps the best documents per item only. A hash sample of the documents is ranked
first: the lowest of an item's best scores there is a score that its best of all
documents reach, so that tasks send little more than what is asked for; every
document is scored all the same.

Null and empty texts and texts without a term are no documents and match nothing;
items without a term have no results. Rows of documents with one doc_id are documents
of their own, rows of items with one item_id items of their own. Equal scores go by
doc_id, null last. Only doc_id, text and item_id, text are read; empty tables give an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import stored

TOP = 50
#: Term occurrences in the items of one block; more items take more passes.
BLOCK_TERMS = 300_000
#: Cells of the table of partial sums that a worker fills at a time.
CELLS = 1_500_000
#: One of so many documents is ranked first, for a bound of the best scores.
SAMPLE = 64
COUNTED = "doc_id bigint, n bigint, terms binary, times binary"
FOUND = "item bigint, doc_id bigint, score bigint"
RANKED = "item_id string, rank int, doc_id bigint, score bigint"

_DIGITS, _LETTERS = b"0123456789", b"abcdefghijklmnopqrstuvwxyz"
#: Bytes of terms as they are (A-Z in lower case), all others as blanks. Bytes from 0x80 are parts of characters beyond ASCII.
_TERM_BYTES = bytes(b if b >= 0x80 or b in _DIGITS + _LETTERS else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII of a UTF-8 text, A-Z in lower case."""
    return text.translate(_TERM_BYTES).split()


@dataclass
class SharingPlan:
    """What is added to what. Rows of the table of sums: first the atoms, then the nodes."""

    terms: list[bytes]
    atom: np.ndarray  # atom of each term
    n_atoms: int
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # nodes, their left and right parts; a level needs earlier ones only
    items: list[int]  # numbers of the items that have terms
    lists: list[list[int]]  # atoms and nodes of each of them
    n_rows: int

    def additions(self) -> int:
        """Additions of rows per batch, sums of atoms aside."""
        return sum(len(level[0]) for level in self.levels) + sum(len(x) - 1 for x in self.lists)

    def sums(self, atoms: np.ndarray) -> np.ndarray:
        """Scores of the items (rows) from the sums of the atoms (rows), for the documents in the columns."""
        table = np.zeros((self.n_rows, atoms.shape[1]))
        table[: self.n_atoms] = atoms
        for nodes, left, right in self.levels:
            table[nodes] = table[left] + table[right]
        flat = np.concatenate([np.array(x) for x in self.lists])
        starts = np.cumsum([0, *[len(x) for x in self.lists[:-1]]])
        return np.add.reduceat(table[flat], starts, axis=0)


def share(items: list[set[bytes]]) -> SharingPlan:
    """Mines the term sets that items share. Work and size follow the number of terms in all items."""
    holders: dict[bytes, list[int]] = defaultdict(list)
    for number, terms in enumerate(items):
        for term in terms:
            holders[term].append(number)
    atoms: dict[tuple[int, ...], list[bytes]] = defaultdict(list)
    for term in sorted(holders):
        atoms[tuple(holders[term])].append(term)
    # frequent atoms first, so that what many items share stands side by side
    order = sorted(atoms, key=lambda h: (-len(h), h))
    terms = [t for h in order for t in atoms[h]]
    atom = np.repeat(np.arange(len(order)), [len(atoms[h]) for h in order])
    lists: dict[int, list[int]] = defaultdict(list)
    for at, held in enumerate(order):
        for number in held:
            lists[number].append(at)
    depth = [0] * len(order)
    made: list[tuple[int, int]] = []
    while True:
        pairs = Counter(pair for x in lists.values() for pair in set(zip(x, x[1:])))
        # pairs without a part in common can be replaced in one round
        taken: dict[int, int] = {}
        chosen: dict[tuple[int, int], int] = {}
        for (left, right), n in sorted(pairs.items(), key=lambda p: (-p[1], p[0])):
            if n < 2:
                break
            if left not in taken and right not in taken:
                taken[left] = taken[right] = chosen[left, right] = len(depth)
                depth.append(1 + max(depth[left], depth[right]))
                made.append((left, right))
        if not chosen:
            break
        for number, x in lists.items():
            out: list[int] = []
            for node in x:
                if out and (out[-1], node) in chosen:
                    out[-1] = chosen[out[-1], node]
                else:
                    out.append(node)
            lists[number] = out
    by_depth: dict[int, list[int]] = defaultdict(list)
    for node in range(len(order), len(depth)):
        by_depth[depth[node]].append(node)
    levels = []
    for d in sorted(by_depth):
        nodes = np.array(by_depth[d])
        parts = np.array([made[n - len(order)] for n in by_depth[d]])
        levels.append((nodes, parts[:, 0], parts[:, 1]))
    numbers = sorted(lists)
    return SharingPlan(terms, atom, len(order), levels, numbers, [lists[n] for n in numbers], len(depth))


def blocks_of(items: DataFrame, block_terms: int) -> Iterator[list[tuple]]:
    """Items as (item_id, terms), in blocks; the driver holds one block."""
    block: list[tuple] = []
    size = 0
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string").cast("binary")).orderBy("item_id", "text")
    for item_id, text in rows.toLocalIterator():
        terms = set(terms_of(bytes(text or b"")))
        if not terms:
            continue
        if block and size + len(terms) > block_terms:
            yield block
            block, size = [], 0
        block.append((item_id, terms))
        size += len(terms)
    if block:
        yield block


def counted(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, n, and the numbers and occurrences of the wanted terms of every document that has a term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # the terms of one block of items

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: at for at, term in enumerate(shared.value)}
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms_of(text)
                if words:
                    tally = Counter(words)
                    found = sorted((number[word], tally[word]) for word in number.keys() & tally.keys())
                    at, times = zip(*found) if found else ((), ())
                    rows.append((doc_id, len(words), np.array(at, "<u4").tobytes(), np.array(times, "<u4").tobytes()))
            doc_ids, sizes, at, times = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(at, pa.binary()), pa.array(times, pa.binary())],
                names=["doc_id", "n", "terms", "times"],
            )

    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary"))
    return texts.mapInArrow(count, COUNTED)


def document_frequencies(documents: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term of the block is. Every task adds its own up first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"), minlength=n_terms)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(total[term])], names=["term", "n"])

    summed = documents.select("terms").mapInArrow(add, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[summed.column("term").to_numpy()] = summed.column("n").to_numpy()
    return out


class Best:
    """The best documents per item so far, and the score that the next must reach."""

    def __init__(self, least: np.ndarray, top: int):
        self.least, self.top = least.copy(), top
        self.item, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.no_id = np.zeros(0, bool)

    def add(self, doc: np.ndarray, no_id: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` has a row per item and a column per document."""
        item, at = np.nonzero(scores >= np.maximum(self.least, 1)[:, None])
        if not len(item):
            return
        self.item, self.doc = np.concatenate([self.item, item]), np.concatenate([self.doc, doc[at]])
        self.no_id, self.score = np.concatenate([self.no_id, no_id[at]]), np.concatenate([self.score, scores[item, at].astype(np.int64)])
        order = np.lexsort((self.doc, self.no_id, -self.score, self.item))
        first = np.searchsorted(self.item[order], np.arange(len(self.least)))
        place = np.arange(len(order)) - first[self.item[order]]
        keep = order[place < self.top]
        self.item, self.doc, self.no_id, self.score = self.item[keep], self.doc[keep], self.no_id[keep], self.score[keep]
        last = place[place < self.top] == self.top - 1
        self.least[self.item[last]] = np.maximum(self.least[self.item[last]], self.score[last])

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.item), pa.array(self.doc, mask=self.no_id), pa.array(self.score)], names=["item", "doc_id", "score"])


def best_of_tasks(documents: DataFrame, shared, top: int) -> DataFrame:
    """item, doc_id, score: each task's best documents per item (numbers of the plan's items)."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights, n_documents, length, least = shared.value
        best = Best(least, top)
        width = max(1, CELLS // (plan.n_rows + sum(map(len, plan.lists))))
        for batch in batches:
            for at in range(0, batch.num_rows, width):
                part = batch.slice(at, width)
                sizes = part.column(1).to_numpy()
                packed = part.column(2).to_pylist()
                held = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
                term = np.frombuffer(b"".join(packed), "<u4")
                tf = np.frombuffer(b"".join(part.column(3).to_pylist()), "<u4").astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), held)
                m = 50 + (50 * sizes * n_documents) // length
                gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                # sums stay below 2^53, so doubles hold them exactly
                atoms = np.bincount(plan.atom[term] * part.num_rows + doc, weights=gain, minlength=plan.n_atoms * part.num_rows)
                scores = plan.sums(atoms.reshape(plan.n_atoms, part.num_rows))
                ids = part.column(0)
                no_id = np.asarray(ids.is_null())
                best.add(np.asarray(ids.fill_null(0)), no_id, scores)
        yield best.batch()

    return documents.mapInArrow(rank, FOUND)


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The best of all tasks per item, ranked from 1; first within salts, so that no item's rows meet in one task unless they are few."""
    by_score = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))
    some = salted.withColumn("place", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*by_score))).where(F.col("place") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by_score))).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, sample: int = SAMPLE) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], RANKED)
    for block in blocks_of(items, block_terms):
        plan = share([terms for _, terms in block])
        documents = stored(counted(docs, plan.terms), "term_counts")
        n_documents, length = documents.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_documents:
            break
        frequency = document_frequencies(documents, len(plan.terms))
        weights = np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)

        def placed(documents: DataFrame, least: np.ndarray, told: tuple = (plan, weights, n_documents, length)) -> DataFrame:
            return ranked(best_of_tasks(documents, spark.sparkContext.broadcast((*told, least)), top), top)

        least = np.zeros(len(plan.items))
        some = documents.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(sample)) == 0)
        for row in placed(some, least).where(F.col("rank") == top).select("item", "score").collect():  # one row per item of the block
            least[row["item"]] = row["score"]
        names = spark.createDataFrame([(at, block[number][0]) for at, number in enumerate(plan.items)], "item bigint, item_id string")
        # names has one row per item of the block
        out = out.unionByName(stored(placed(documents, least).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score"), "ranked"))
    return out.withColumn("item_id", F.col("item_id").cast(kind))
