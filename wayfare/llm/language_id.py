"""Language identification by unigram pieces, with all segmentations summed.

A fixed public vocabulary gives the pieces. Each language has a probability per
piece, learned by expectation-maximisation over word counts; a word's probability
is the sum over all ways to cut it into pieces (forward algorithm), a text's the
product over its words. Every whole text is scored; words are runs of letters in
lower case, of any length. The sums run over the whole word: they are worked out
block by block, and each block starts from the last sums of the one before, scaled.

Learning reads at most about ``train_docs`` rows per language, picked by a hash of
doc_id, from rows with a language that are not held out; of more than
``MAX_LANGUAGES`` values of lang those with most rows are learned. Texts that are null or
have no letter are ``und`` with score 0, and so is everything where no row could
be learned from. Equal scores go to the language that sorts first. Repeated rows
give repeated results; a null doc_id is carried along and never learned from.
Only doc_id, text and, for learning, lang are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import hands_back, is_held_out, stored, text_of

TRAIN_DOCS = 4000
ROUNDS = 3
SMOOTHING = 0.1
MAX_LANGUAGES = 256
#: Letters after which sums are scaled; the least probability to this power is still a normal double.
BLOCK_LETTERS = 32
#: Numbers of the table of piece probabilities that is filled at a time.
CELLS = 1_000_000
#: Words whose scores a worker keeps, and their letters in all; beyond that it starts anew.
CACHE_WORDS = 100_000
CACHE_LETTERS = 2_000_000
#: Rows that are scored at a time.
SLICE_ROWS = 500
#: Bytes of text that are cut into words at a time.
TEXT_BYTES = 1 << 20
UNKNOWN = 1e-7
HINT_BITS = 20
ROLL, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
UNDETERMINED = "und"
_RUN = re.compile(r"[^\W\d_]+")
_BOUNDARY = "▁"


def letter_pieces(model_path: str) -> list[str]:
    """Pieces of the public vocabulary made of letters, in lower case; a leading mark stands for the start of a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == _BOUNDARY or p.removeprefix(_BOUNDARY).isalpha())


def rolled(codes: np.ndarray) -> np.ndarray:
    """A digest of a string of code points."""
    out = np.zeros(1, np.uint64)
    for code in codes:
        out = out * ROLL + code
    return out


def hint_place(digests: np.ndarray) -> np.ndarray:
    return ((digests * SPREAD) >> np.uint64(64 - HINT_BITS)).astype(np.int64)


def words(text: str) -> list[str]:
    return _RUN.findall(text.lower())


def letters(run: str) -> str:
    return run if run.isalpha() else "".join(c for c in run if c.isalpha())


@dataclass
class PieceModel:
    """Languages, pieces, and a row of probabilities per piece; the last row is of letters without a piece."""

    languages: list[str]
    pieces: list[str]
    probability: np.ndarray  # pieces + 1, languages

    def __post_init__(self):
        keys = np.array([rolled(np.array([p]).view(np.uint32).astype(np.uint64))[0] for p in self.pieces], np.uint64)
        self.places = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.places]
        self.hint = np.zeros(1 << HINT_BITS, bool)
        self.hint[hint_place(self.keys)] = True

        self.longest = max(map(len, self.pieces), default=1)

    def lattice(self, codes: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Piece ids that end before each place from ``begin`` to ``end``, by length; -1 where there is none.

        ``codes`` has a row of code points per word, all of one length, so the digests
        of all their pieces of a length are made together.
        """
        back = max(0, begin - self.longest + 1)
        part = codes[:, back:end]
        size, skip = part.shape[1], begin - back
        out = np.full((len(part), end - begin, self.longest + 1), -1, np.int32)
        digest = np.zeros((len(part), size + 1), np.uint64)
        for length in range(1, min(self.longest, size) + 1):
            digest = digest[:, : size - length + 1] * ROLL + part[:, length - 1 :]
            row, start = np.nonzero(self.hint[hint_place(digest)])
            inside = start + length > skip
            row, start = row[inside], start[inside]
            found = digest[row, start]
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            same = self.keys[at] == found
            out[row[same], start[same] + length - 1 - skip, length] = self.places[at[same]]
        alone = out[:, :, 1]
        alone[alone < 0] = len(self.pieces)
        return out

    def table(self) -> np.ndarray:
        """Probabilities with a row of zeros last, which stands for no piece."""
        return np.vstack([self.probability, np.zeros((1, self.probability.shape[1]))])


def codes_of(marked: list[str]) -> np.ndarray:
    return np.array(marked).view(np.uint32).reshape(len(marked), -1).astype(np.uint64)


def marked_word(run: str) -> str:
    """The letters of a word with the mark of a word's start."""
    return _BOUNDARY + letters(run)


def by_length(words: list[str], width: int) -> Iterator[list[int]]:
    """Places of the words in groups of equal length, so that lattices are dense; ``width`` numbers per letter are needed."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for cut in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        most = max(1, CELLS // max(1, width * min(BLOCK_LETTERS, int(lengths[cut[0]])))) if len(cut) else 1
        for at in range(0, len(cut), most):
            yield cut[at : at + most].tolist()


def block_sums(before: np.ndarray, p: np.ndarray, begin: int) -> np.ndarray:
    """Summed probability of all cuts up to each place of a block, after the sums of the places ``before`` it (words, places, languages)."""
    reach, n = before.shape[1], p.shape[1]
    out = np.concatenate([before, np.zeros((len(p), n, p.shape[-1]))], axis=1)
    for k in range(n):
        most = min(begin + k + 1, reach)
        # pieces of length 1..most start at the places before this one
        out[:, reach + k] = (out[:, reach + k - most : reach + k][:, ::-1] * p[:, k, 1 : most + 1]).sum(axis=1)
    return out


def first_sums(words: int, longest: int, languages: int) -> np.ndarray:
    out = np.zeros((words, longest, languages))
    out[:, -1] = 1
    return out


def scaled(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums divided by the last of each word and language, and its logarithm.

    The last one is never zero: a letter without a piece has a probability as well.
    """
    last = sums[:, -1:]
    return sums / last, np.log(last[:, 0])


def log_scores(model: PieceModel, runs: list[str]) -> np.ndarray:
    """Log probability of each word in each language; zeros for runs without a letter."""
    out = np.zeros((len(runs), len(model.languages)))
    place = [i for i, run in enumerate(runs) if letters(run)]
    marked, table = [marked_word(runs[i]) for i in place], model.table()
    for group in by_length(marked, (model.longest + 1) * len(model.languages)):
        codes = codes_of([marked[g] for g in group])
        before, scale = first_sums(len(group), model.longest, len(model.languages)), 0.0
        for begin in range(0, codes.shape[1], BLOCK_LETTERS):
            p = table[model.lattice(codes, begin, min(begin + BLOCK_LETTERS, codes.shape[1]))]
            sums = block_sums(before, p, begin)
            before, more = scaled(sums[:, -model.longest :])
            scale = scale + more
        out[[place[g] for g in group]] = scale
    return out


def expected_counts(model: PieceModel, frame: pd.DataFrame) -> np.ndarray:
    """How often each piece is used, in expectation over all cuts of the counted words (columns lang, word, n).

    A first walk keeps the sums of all places, scaled by block; a second one from the
    end sums over what follows each place and shares each word out among its pieces.
    """
    counts, table = np.zeros(model.probability.shape), model.table()
    at = {name: i for i, name in enumerate(model.languages)}
    rows = [(marked_word(word), at[lang], n) for lang, word, n in frame.itertuples(index=False) if letters(word)]
    longest = model.longest
    for group in by_length([r[0] for r in rows], longest + 1):
        codes = codes_of([rows[g][0] for g in group])
        column = np.array([rows[g][1] for g in group])
        weight = np.array([rows[g][2] for g in group], float)
        begins = range(0, codes.shape[1], BLOCK_LETTERS)
        before, scale, kept = first_sums(len(group), longest, 1), np.zeros(len(group)), []
        for begin in begins:
            ids = model.lattice(codes, begin, min(begin + BLOCK_LETTERS, codes.shape[1]))
            sums = block_sums(before, table[ids, column[:, None, None]][..., None], begin)
            kept.append((sums[..., 0], scale))
            before, more = scaled(sums[:, -longest:])
            scale = scale + more[:, 0]
        whole = scale
        after, gone = np.zeros((len(group), longest)), np.zeros(len(group))
        after[:, -1] = 1  # nothing follows the end
        for begin, (sums, scale) in reversed(list(zip(begins, kept))):
            n = sums.shape[1] - longest
            ids = model.lattice(codes, begin, begin + n)
            p = table[ids, column[:, None, None]]
            # what follows each place, from ``longest`` places before the block to its end
            beta = np.concatenate([np.zeros((len(group), n)), after], axis=1)
            share = weight * np.exp(scale + gone - whole)
            for k in range(n - 1, -1, -1):
                end = longest + k
                for length in range(1, min(begin + k + 1, longest) + 1):
                    found = ids[:, k, length]
                    use = np.flatnonzero(found >= 0)
                    if len(use):
                        flow = p[use, k, length] * beta[use, end]
                        beta[use, end - length] += flow
                        np.add.at(counts, (found[use], column[use]), flow * sums[use, end - length] * share[use])
            after, more = scaled(beta[:, :longest, None])
            after, gone = after[..., 0], gone + more[:, 0]
    return counts


def train(docs: DataFrame, model_path: str, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> PieceModel:
    """Piece probabilities per language from rows that are not held out and have a language.

    Word counts are merged by Spark; what reaches the driver is one number per
    language and piece.
    """
    pieces = letter_pieces(model_path)
    rows = docs.select("doc_id", text_of().alias("t"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))
    )
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    languages = sorted(totals)
    if not languages:
        return PieceModel([], pieces, np.zeros((len(pieces) + 1, 0)))
    share = F.coalesce(*[F.when(F.col("lang") == name, F.lit(train_docs / n)) for name, n in totals.items()])
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            tally: dict[tuple[str, str], int] = {}
            for text, lang in zip(frame["t"], frame["lang"]):
                for word in words(text):
                    tally[lang, word] = tally.get((lang, word), 0) + 1
            yield pd.DataFrame([(lang, word, n) for (lang, word), n in tally.items()], columns=["lang", "word", "n"])

    counted = sample.select("t", "lang").mapInPandas(count, "lang string, word string, n bigint")
    counted = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    probability = np.full((len(pieces) + 1, len(languages)), 1.0 / len(pieces))
    probability[-1] = UNKNOWN
    for _ in range(rounds):
        model = PieceModel(languages, pieces, probability)

        def expect(frames: Iterator[pd.DataFrame], model: PieceModel = model) -> Iterator[pd.DataFrame]:
            total = np.zeros(model.probability.shape)
            for frame in frames:
                total += expected_counts(model, frame[["lang", "word", "n"]])
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "c": total[piece, lang]})

        summed = counted.mapInPandas(expect, "piece int, lang int, c double").groupBy("piece", "lang").agg(F.sum("c").alias("c")).toPandas()
        counts = np.zeros(probability.shape)
        counts[summed["piece"], summed["lang"]] = summed["c"]
        counts = counts[:-1] + SMOOTHING
        probability = np.vstack([counts / counts.sum(axis=0), np.full((1, len(languages)), UNKNOWN)])
    return PieceModel(languages, pieces, probability)


class WordScores:
    """Scores of words met so far."""

    def __init__(self, model: PieceModel):
        self.model, self.place, self.scores, self.has = model, {}, np.zeros((0, len(model.languages))), np.zeros(0, bool)
        self.letters = 0

    def learn(self, runs: set[str]) -> None:
        if len(self.place) > CACHE_WORDS or self.letters > CACHE_LETTERS:
            self.__init__(self.model)
        new = [r for r in runs if r not in self.place]
        if new:
            start = len(self.place)
            self.place.update((r, start + i) for i, r in enumerate(new))
            self.letters += sum(map(len, new))
            self.scores = np.vstack([self.scores, log_scores(self.model, new)])
            self.has = np.concatenate([self.has, [bool(letters(r)) for r in new]])

    def texts(self, texts: list[str]) -> list[tuple[str, float]]:
        """Predicted language and its share of the probability, per text."""
        out = []
        begin = size = 0
        for at, text in enumerate(texts):
            size += len(text)
            if size < TEXT_BYTES and at < len(texts) - 1:
                continue
            cut = [words(t) for t in texts[begin : at + 1]]
            begin, size = at + 1, 0
            self.learn({w for c in cut for w in c})
            for runs in cut:
                found = np.fromiter(map(self.place.__getitem__, runs), np.int64, len(runs))
                if not self.model.languages or not self.has[found].any():
                    out.append((UNDETERMINED, 0.0))
                    continue
                total = self.scores[found].sum(axis=0)
                best = int(total.argmax())
                out.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def predict(docs: DataFrame, model: PieceModel, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns of ``docs`` with the predicted language and its score added last, under ``names``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.pieces, model.probability))
    place = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(PieceModel(*shared.value))
        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            got = scores.texts([t or "" for t in batch.column(place).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[*batch.schema.names, *names],
            )

    added = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return docs.mapInArrow(hands_back(score), T.StructType([*docs.schema.fields, *added]))


def language_id(docs: DataFrame, model_path: str, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    model = train(docs, model_path, train_docs)
    predicted = predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
