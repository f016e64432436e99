"""Rules, classifier, licences, language: edge rows, brute force and held-out accuracy."""

from __future__ import annotations

import itertools
import math
import random
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from tests.llm.conftest import edge_rows, frame
from wayfare.llm import language_id, license_scan, quality_knn, quality_rules

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_rules_on_edge_rows(edges, empty):
    rows = quality_rules.quality_rules(edges).collect()
    assert len(rows) == len(edge_rows())
    by = [(r["doc_id"], r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in rows]
    assert (3, 0, 0, True, False) in by and (4, 0, 0, True, False) in by and (5, 0, 0, True, False) in by and (None, 0, 0, True, False) in by
    assert [b[1] for b in by if b[0] == 1] == [80, 80]
    assert quality_rules.quality_rules(empty).count() == 0


def repeated_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(covered)


def test_repeated_windows_against_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 2, 3, 4, 9, 30, 100)] + ["a a a a", "x y z x y z", "a b c d"]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.figures(frame(spark, list(enumerate(texts)))).collect()}
    assert got == {i: repeated_words(t.split()) for i, t in enumerate(texts)}


def test_rule_table_is_a_parameter(spark):
    rule = quality_rules.Rule("few", "n_words", high=5)
    docs = frame(spark, [(1, "one two three"), (2, "one two three four five six")])
    rows = {r["doc_id"]: (r["kept"], r["broken_rules"]) for r in quality_rules.quality_rules(docs, [rule], min_words=1).collect()}
    assert rows == {1: (True, []), 2: (False, ["few"])}


def test_rules_plan_has_no_python_and_no_shuffle(edges):
    plan = quality_rules.quality_rules(edges)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan


def test_licences(spark, edges, empty):
    mit = license_scan.KNOWN["MIT"][-1]
    docs = frame(spark, [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (2, "prose\nreleased under the MIT   licence\nmore"),
        (3, "Released under the MIT License, mostly"), (4, "copyright is a long story"), (None, "SPDX-License-Identifier: MIT"),
        (5, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."), (6, mit.replace("\n", " ")),
    ])
    rows = {r["doc_id"]: (r["text_license"], r["licenses"], r["n_lines"]) for r in license_scan.license_scan(docs).collect()}
    assert rows == {1: ("MIT", "MIT", 0), 2: (None, "MIT", 1), None: ("MIT", "MIT", 1), 5: (None, "CC-BY-NC-4.0 MIT", 2), 6: ("MIT", "MIT", 1)}
    assert license_scan.license_scan(edges).count() == 0 and license_scan.license_scan(empty).count() == 0
    plan = license_scan.license_scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_known_table_is_bounded(spark):
    with pytest.raises(ValueError):
        license_scan.known_digests(spark, {"X": tuple(map(str, range(license_scan.MAX_KNOWN + 1)))})


def test_whole_licences_are_known(spark):
    """Whole texts as they lie in repositories: below a copyright line or title, rewrapped, without the part after the terms."""
    folder = Path(license_scan.__file__).parent / "licenses"
    text = lambda name: (folder / f"{name}.txt").read_text("utf-8")
    names = ["Apache-2.0", "GPL-3.0", "MPL-2.0", "CC0-1.0", "BSD-2-Clause", "BSD-3-Clause"]
    docs = [(i, " ".join(text(name).upper().split(" "))) for i, name in enumerate(names)]
    want = dict(enumerate(names))
    others = [
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\n" + text("BSD-3-Clause")),
        ("BSD-2-Clause", "Copyright 2021 Some One\n\n" + text("BSD-2-Clause").replace("1. ", "* ").replace("2. ", "* ")),
        ("MIT", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + license_scan.KNOWN["MIT"][-1]),
        ("Apache-2.0", text("Apache-2.0").split("APPENDIX")[0]),
        (None, text("Apache-2.0").replace("perpetual", "yearly", 1)),
        (None, text("BSD-3-Clause") + "\nand more"),
    ]
    for i, (name, body) in enumerate(others, 100):
        docs.append((i, body))
        want |= {i: name} if name else {}
    found = license_scan.license_scan(frame(spark, docs)).where("text_license is not null")
    assert {r["doc_id"]: r["text_license"] for r in found.collect()} == want


def test_quality_votes_on_held_out_rows(spark, data):
    data = data.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    scored = quality_knn.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in scored)
    assert len(scored) > 100 and right / len(scored) > 0.97
    bad = [r["score"] for r in scored if r["quality"] == 0]
    good = [r["score"] for r in scored if r["quality"] == 1]
    assert np.mean([[b < g for g in good] for b in bad]) > 0.99


def test_quality_edge_rows(spark, edges, empty):
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, None), (8, 1), (2, 0), (None, 1)], "doc_id bigint, quality int")
    rows = quality_knn.quality_scores(edges, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    none = labels.where("false")
    assert {r["score"] for r in quality_knn.quality_scores(edges, none).collect()} == {0.5}
    assert quality_knn.quality_scores(empty, labels).count() == 0


def test_quality_sees_words(spark):
    """Both labels have the same shapes: words of as many letters, one sentence, no repetition."""
    rng = random.Random(8)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(800)]
    half = [words[:500], words[300:]]  # 200 words are common to both
    rows = [(i, " ".join(rng.sample(half[i % 2], 40)) + ".") for i in range(900)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    got = [(r["score"], r["doc_id"] % 2) for r in quality_knn.quality_scores(frame(spark, rows), labels).collect() if r["held_out"]]
    bad, good = [s for s, label in got if label == 0], [s for s, label in got if label == 1]
    assert len(got) > 200 and np.mean([[b < g for g in good] for b in bad]) > 0.95


def test_of_several_texts_with_one_id_the_smallest_is_learned(spark):
    rows = [(1, "a good text. It has words"), (1, "zzz 1 2 3"), (2, "bad bad bad")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    models = [quality_knn.train(frame(spark, order), labels) for order in (rows, rows[::-1])]
    assert (models[0].vectors == models[1].vectors).all() and len(models[0].labels) <= 2


def test_singular_vectors():
    rng = np.random.default_rng(3)
    matrix = (rng.standard_normal((60, 5)) * [9, 7, 5, 3, 1]) @ rng.standard_normal((5, 40))
    got, want = quality_knn.singular_vectors(matrix.astype(np.float32), 4), np.linalg.svd(matrix)[2][:4].T
    assert np.allclose(np.abs((got * want).sum(axis=0)), 1, atol=1e-3)


def test_votes_equal_plain_cosine_search():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab C1.\n") for _ in range(rng.randrange(5, 200))) for _ in range(80)]
    parsed = [(*quality_knn.term_codes(t), np.array(quality_knn.repeats(t))) for t in texts]
    labels = np.array([rng.randrange(2) for _ in texts], float)
    model = quality_knn.fit(parsed, labels, terms=200, dimensions=8)
    queries = ["".join(rng.choice("ab C1.\n") for _ in range(50)) for _ in range(10)] + [""]
    vectors = model.vectors_of(queries)
    for vector, score in zip(vectors, model.scores(queries)):
        cosines = [float(vector @ v) for v in model.vectors]
        near = sorted(range(len(texts)), key=lambda i: -cosines[i])[: quality_knn.NEIGHBOURS]
        votes = [max(cosines[i], 0) ** quality_knn.SHARPNESS for i in near]
        want = sum(v * labels[i] for v, i in zip(votes, near)) / sum(votes) if sum(votes) else labels.mean()
        assert score == pytest.approx(want, abs=1e-3)


def cuts(word):
    for n in range(len(word)):
        for at in itertools.combinations(range(1, len(word)), n):
            edges = [0, *at, len(word)]
            yield [word[a:b] for a, b in zip(edges, edges[1:])]


def test_forward_algorithm_sums_all_cuts():
    rng = np.random.default_rng(0)
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"]
    model = language_id.PieceModel(["x", "y"], pieces, rng.random((len(pieces) + 1, 2)))
    for run in ("a", "ab", "abab", "abca", "ccc"):
        want = np.zeros(2)
        for cut in cuts("▁" + run):
            rows = [model.pieces.index(p) if p in pieces else len(pieces) if len(p) == 1 else None for p in cut]
            if None not in rows:
                want += np.prod([model.probability[r] for r in rows], axis=0)
        assert np.allclose(language_id.log_scores(model, [run])[0], np.log(want))


def test_whole_words_of_any_length():
    """Sums over all cuts of words that are longer than a block, with pieces that are longer than most words."""
    rng = np.random.default_rng(6)
    pieces = sorted(["▁", "a", "b", "ab", "ba", "aab", "▁ab", "babab", "a" * 15, "ab" * 10])
    model = language_id.PieceModel(["x", "y"], pieces, rng.random((len(pieces) + 1, 2)) * 0.3)

    def summed(word):
        sums = [np.ones(2)]
        for end in range(1, len(word) + 1):
            total = np.zeros(2)
            for length in range(1, end + 1):
                piece = word[end - length : end]
                if piece in pieces or length == 1:
                    total += sums[end - length] * model.probability[pieces.index(piece) if piece in pieces else -1]
            sums.append(total)
        return np.log(sums[-1])

    runs = ["abbaababba" * 3, "a" * 33, "ab" * 50, "c" * 40, "ac" * 40]
    for run, got in zip(runs, language_id.log_scores(model, runs)):
        assert np.allclose(got, summed("▁" + run)), run
    # letters without a piece, far below the least double
    alone = 5000 * np.log(model.probability[-1]) + np.log(model.probability[pieces.index("▁")])
    assert np.allclose(language_id.log_scores(model, ["c" * 5000])[0], alone)


def test_expected_counts_are_derivatives():
    """How often a piece is used, in expectation, is the derivative of the log probability by that of the piece."""
    rng = np.random.default_rng(7)
    pieces = sorted(["▁", "a", "b", "ab", "ba", "aab", "▁ab", "babab"])
    model = language_id.PieceModel(["x"], pieces, rng.random((len(pieces) + 1, 1)) * 0.3)
    for run in ("abba", "ab" * 20, "aab" * 30 + "c"):
        counts = language_id.expected_counts(model, pd.DataFrame([("x", run, 3)], columns=["lang", "word", "n"]))
        for row in range(len(pieces) + 1):
            kept, step = model.probability[row, 0], 1e-6
            sides = []
            for sign in (1, -1):
                model.probability[row, 0] = kept * (1 + sign * step)
                sides.append(language_id.log_scores(model, [run])[0, 0])
            model.probability[row, 0] = kept
            assert counts[row, 0] == pytest.approx(3 * (sides[0] - sides[1]) / (2 * step), abs=1e-3)


def test_languages_of_held_out_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    predicted = language_id.language_id(docs, PIECES).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(predicted) > 20 and sum(r["lang"] == r["lang_pred"] for r in predicted) / len(predicted) > 0.95


def test_language_edge_rows(spark, empty):
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(0, 40)] + [(i, "der hund und die katze " * 5, "de") for i in range(40, 80)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 34 !? ²", None), (103, "the dog", None), (None, "und die katze", "en"), (104, "x" * 100_000, None)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.language_id(frame(spark, rows), PIECES).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103][0] == "en" and got[None][0] == "de" and got[104][0] in ("de", "en")
    assert all(0 <= s <= 1 and not math.isnan(s) for _, s in got.values())
    unlearned = language_id.language_id(frame(spark, [(1, "the dog")]), PIECES).collect()
    assert [(r["lang_pred"], r["score"]) for r in unlearned] == [("und", 0.0)]
    assert language_id.language_id(empty, PIECES).count() == 0
