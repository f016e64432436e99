"""Quality by nearest-neighbour voting in a latent-semantic space.

The terms of a text are the three-character patterns of its shape (case, digits,
white space, each punctuation mark), its words in lower case, hashed, and its
repetitions (words, word triples and lines that occurred before). Weighted terms of a
bounded sample of labelled rows give a truncated singular value decomposition; its
vectors with their labels are broadcast, and every document votes by exact cosine
products in blocks.

The sample is the first ``train_docs`` labelled rows that are not held out, in
order of a hash of doc_id, so model and broadcast have a size that does not grow
with the data. Labels, lang, source and doc_id are no input of a score. Null and
empty texts have no terms and get the share of label 1 in the sample, as does
everything when the neighbours tell nothing; 0.5 where no labelled row is there.
Of repeated labels of a doc_id the largest counts, null labels do not; of several
texts with a sampled doc_id the smallest is learned. Equal
similarities keep the order of the sample. Repeated rows give repeated results;
a null doc_id is carried along.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import is_held_out, text_of

TRAIN_DOCS = 4096
#: Patterns and hashed words that are kept, those in most sampled rows first.
TERMS = 2048
WORDS = 2048
DIMENSIONS = 64
#: Rounds of the iteration for the singular vectors, and vectors carried besides those wanted.
ROUNDS, SPARE = 12, 32
NEIGHBOURS = 25
#: Power of the cosine with which a neighbour votes.
SHARPNESS = 8
BLOCK = 256
PATTERNS = 32 ** 3
WORD_CODES = 1 << 15
#: Weight of all words of a text, compared with all its patterns.
WORD_WEIGHT = 0.5
#: Repetition terms, after patterns and words: words, triples, lines.
REPEATS = 3
REPEAT_WEIGHT = 6.0


def shape_table() -> np.ndarray:
    """Class of each byte: 1 lower case and all beyond ASCII, 2 upper case, 3 digits, 4 blank, 5 other space, then marks."""
    table = np.zeros(256, np.int32)
    table[128:] = 1
    table[97:123] = 1
    table[65:91] = 2
    table[48:58] = 3
    table[[0x20]] = 4
    table[9:14] = 5
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for place, mark in enumerate(marks):
        table[mark] = 6 + place % 26
    return table


SHAPES = shape_table()


def patterns(text: str) -> np.ndarray:
    """Codes of the three-character shapes of a text, in order."""
    shapes = SHAPES[np.frombuffer(text.encode(), np.uint8)]
    return (shapes[:-2] << 10) | (shapes[1:-1] << 5) | shapes[2:] if len(shapes) > 2 else np.zeros(0, np.int32)


#: Bytes of words as they are, all others as blanks; bytes from 0x80 are parts of characters beyond ASCII.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))


def term_codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's patterns, then of its hashed words, and how often each occurs."""
    codes, n = np.unique(patterns(text), return_counts=True)
    tally = Counter(text.lower().encode().translate(_WORD_BYTES).split())
    words = np.fromiter((zlib.crc32(w) for w in tally), np.int64, len(tally)) % WORD_CODES
    times = np.bincount(words, weights=np.fromiter(tally.values(), np.int64, len(tally)), minlength=0).astype(np.int64)
    held = np.flatnonzero(times)
    return np.concatenate([codes, PATTERNS + held]), np.concatenate([n, times[held]])


def repeats(text: str) -> tuple[float, float, float]:
    """Shares of words equal to the one before, of word triples met before, of lines met before."""
    words, lines = text.split(), text.split("\n")
    if not words:
        return 0.0, 0.0, 0.0
    after = sum(map(operator.eq, words, words[1:])) / len(words)
    triples = max(len(words) - 2, 0)
    again = (triples - len(set(zip(words, words[1:], words[2:])))) / triples if triples else 0.0
    return after, again, (len(lines) - len(set(lines))) / len(lines)


@dataclass
class LatentModel:
    """Columns of the kept patterns and words, term weights, projection, and the labelled vectors."""

    column: np.ndarray  # code to column, -1 if dropped
    n_patterns: int
    weight: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def vectors_of(self, texts: list[str]) -> np.ndarray:
        """Unit vectors in the latent space; zeros for texts without terms."""
        n_terms = len(self.weight)
        counts = np.zeros((len(texts), n_terms), np.float32)
        for row, text in enumerate(texts):
            codes, n = term_codes(text)
            columns = self.column[codes]
            counts[row, columns[columns >= 0]] = n[columns >= 0]
            counts[row, n_terms - REPEATS :] = repeats(text)
        return normalised(weighted(counts, self.n_patterns, self.weight) @ self.projection)

    def scores(self, texts: list[str]) -> np.ndarray:
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(texts), prior)
        if not len(self.labels):
            return out
        near = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            cosine = self.vectors_of(texts[at : at + BLOCK]) @ self.vectors.T
            top = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            votes = np.maximum(np.take_along_axis(cosine, top, axis=1), 0.0).astype(np.float64) ** SHARPNESS
            total = votes.sum(axis=1)
            said = (votes * self.labels[top]).sum(axis=1)
            out[at : at + BLOCK] = np.where(total > 0, said / np.where(total > 0, total, 1), prior)
        return np.clip(out, 0.0, 1.0)


def weighted(counts: np.ndarray, n_patterns: int, weight: np.ndarray) -> np.ndarray:
    """Square roots of the shares among patterns and among words, so that length does not matter, and repetitions as they are; times the weights."""
    out = counts.astype(np.float32, copy=True)
    for shares in (out[:, :n_patterns], out[:, n_patterns : counts.shape[1] - REPEATS]):
        total = shares.sum(axis=1, keepdims=True)
        shares[:] = np.sqrt(shares / np.where(total > 0, total, 1))
    return out * weight


def normalised(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norm > 0, norm, 1)).astype(np.float32)


def singular_vectors(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """Right singular vectors of the largest singular values, by orthogonal iteration."""
    start = np.random.default_rng(0).standard_normal((matrix.shape[1], min(matrix.shape[1], dimensions + SPARE)))
    basis = np.linalg.qr(start)[0].astype(np.float32)
    for _ in range(ROUNDS):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    # within the basis, the vectors of the small matrix are in order of their values
    turn = np.linalg.svd(matrix @ basis, full_matrices=False)[2]
    return (basis @ turn.T)[:, :dimensions].astype(np.float32)


def fit(
    counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, terms: int = TERMS, dimensions: int = DIMENSIONS, words: int = WORDS
) -> LatentModel:
    """Model from (codes, counts, repetitions) per sampled row."""
    held = np.zeros(PATTERNS + WORD_CODES, np.int64)
    for codes, _, _ in counts:
        held[codes] += 1
    chosen = []
    for first, end, most in ((0, PATTERNS, terms), (PATTERNS, PATTERNS + WORD_CODES, words)):
        part = held[first:end]
        chosen.append(first + np.sort(np.argsort(-part, kind="stable")[: min(most, int((part > 0).sum()))]))
    kept, n_patterns = np.concatenate(chosen), len(chosen[0])
    column = np.full(len(held), -1, np.int64)
    column[kept] = np.arange(len(kept))
    n_terms = len(kept) + REPEATS
    matrix = np.zeros((len(counts), n_terms), np.float32)
    for row, (codes, n, repeated) in enumerate(counts):
        use = column[codes] >= 0
        matrix[row, column[codes[use]]] = n[use]
        matrix[row, n_terms - REPEATS :] = repeated
    rarity = np.log((1 + len(counts)) / (1 + held[kept])) + 1
    rarity[n_patterns:] *= WORD_WEIGHT
    weight = np.concatenate([rarity, np.full(REPEATS, REPEAT_WEIGHT)]).astype(np.float32)
    matrix = weighted(matrix, n_patterns, weight)
    projection = singular_vectors(matrix, dimensions)
    return LatentModel(column, n_patterns, weight, projection, normalised(matrix @ projection), labels)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", train_docs: int = TRAIN_DOCS) -> LatentModel:
    """The model of a bounded sample; at most ``train_docs`` rows of term counts reach the driver."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~is_held_out(F.col("doc_id"))
    )
    present = docs.select("doc_id").where(F.col("doc_id").isNotNull())
    sample = (
        known.join(present, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    )

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, text, label_value in zip(frame["doc_id"], frame["t"], frame["label"]):
                codes, n = term_codes(text)
                rows.append((doc_id, label_value, codes.astype("<i4").tobytes(), n.astype("<i4").tobytes(), list(repeats(text))))
            yield pd.DataFrame(rows, columns=["doc_id", "label", "codes", "n", "repeated"])

    texts = docs.select("doc_id", text_of().alias("t")).join(F.broadcast(sample), "doc_id")  # bounded by train_docs
    texts = texts.groupBy("doc_id").agg(F.min("t").alias("t"), F.max("label").alias("label"))
    counted = texts.mapInPandas(count, "doc_id bigint, label int, codes binary, n binary, repeated array<double>")
    rows = sorted(counted.collect(), key=lambda r: r["doc_id"])
    if not rows:
        return LatentModel(np.full(PATTERNS + WORD_CODES, -1, np.int64), 0, np.ones(REPEATS, np.float32), np.zeros((REPEATS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    parsed = [(np.frombuffer(r["codes"], "<i4"), np.frombuffer(r["n"], "<i4"), np.array(r["repeated"])) for r in rows]
    return fit(parsed, np.array([r["label"] for r in rows], float))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(train(docs, labels, label, train_docs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = model.scores([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id bigint, score double")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
