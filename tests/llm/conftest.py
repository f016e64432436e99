from __future__ import annotations

import random

import pytest

from wayfare.llm.common import ship_package

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, score string, kept string, part string, h string, t string, " \
    "_row string, _part string, _bytes string, _kept string, _spans string, _lang_pred string, _lang_score string, _digest string, _head string, _no_text string"


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship_package(spark)


def frame(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang), with further columns whose names clash with computed ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1]), *["x"] * 16) for r in rows]
    return spark.createDataFrame(full, COLUMNS)


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls, empty and blank texts, one word, repeated rows, ties, and a very long text."""
    rng = random.Random(5)
    text = prose(rng, 80)
    return [
        (1, text), (1, text), (2, text), (None, text), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one"),
        (None, None), (8, prose(rng, 60_000, 5000)), (9, "a b c"), (10, "ÀÉ ü ß 漢字 \U0001f600 x\x00y"), (11, None),
    ]


@pytest.fixture
def edges(spark):
    return frame(spark, edge_rows())


@pytest.fixture
def empty(spark):
    return frame(spark, [])
