"""Similarity join, repeated strings, decontamination, components: against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm.conftest import edge_rows, frame, prose
from wayfare.llm import components, decontaminate, jaccard_join, suffix_arrays, suffix_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def grams(text, size=5):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in SPACE.split(lower) if w]
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def brute_groups(docs):
    """Per row: set size and smallest reachable doc_id."""
    sets = [grams(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=repr)


def near_copies(seed=3):
    """Groups of copies with few to many edits, a passage in all of them, and texts of all lengths."""
    rng, out = random.Random(seed), []
    passage = prose(rng, 20)
    for group in range(6):
        base = prose(rng, rng.choice([30, 90, 200])).split()
        for _ in range(rng.choice([2, 5, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(1000)}"
            out.append(passage + "\n" + " ".join(copy))
    out += [prose(rng, n) for n in (1, 2, 3, 4, 5, 6, 300)] + ["a b c", "A  b\tc", "one", "One"]
    ids = rng.sample(range(1000), len(out))
    return list(zip(ids, out))


@pytest.mark.parametrize("list_entries, chunk", [(20_000, 2_000), (3, 4)])
def test_similar_components(spark, list_entries, chunk):
    docs = near_copies()
    got = jaccard_join.similar_components(frame(spark, docs).repartition(3), list_entries=list_entries, chunk=chunk)
    assert rows(got) == brute_groups(docs)


def test_a_hot_class_meets_its_only_near_copy(spark):
    """All n-grams that the copies share with the one near copy are in split lists, mostly in different sub-lists."""
    rng, texts = random.Random(12), []
    for _ in range(6):
        base = prose(rng, 24)
        texts += [base] * 30 + [base + " end"]
    docs = list(enumerate(texts))
    got = jaccard_join.similar_components(frame(spark, docs).repartition(3), list_entries=3, chunk=4)
    assert rows(got) == brute_groups(docs)


def test_similar_components_edge_rows(spark, edges, empty):
    assert rows(jaccard_join.similar_components(edges)) == brute_groups(edge_rows())
    assert jaccard_join.similar_components(empty).count() == 0


def test_leading_part_is_long_enough():
    for n in range(1, 400):
        assert 100 * (n - jaccard_join.leading(n, 75)) < 75 * n


def test_places_round_trip():
    rng = np.random.default_rng(2)
    places = np.sort(rng.integers(0, 1 << 32, 1000))
    assert jaccard_join.unpacked(jaccard_join.packed(places)).tolist() == places.tolist()


def test_signature_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, len(a) // 2), rng.integers(0, 2**63, 20).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert np.bitwise_count(jaccard_join.signature(a, 4) ^ jaccard_join.signature(b, 4)).sum() <= apart
        assert jaccard_join.apart_at_least(jaccard_join.long_signature(a), jaccard_join.long_signature(b)) <= apart


def test_connected_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2060)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = components.connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert rows(found) == sorted(((x, find(x)) for x in linked), key=repr)


@pytest.mark.parametrize("letters", [b"ab", b"abcdefgh", b"\0\1", b"a"])
def test_suffix_arrays(letters):
    rng = random.Random(6)
    for n in (1, 2, 7, 130, 700):
        text = bytes(rng.choice(letters) for _ in range(n)) * 2
        order = suffix_arrays.suffix_array(np.frombuffer(text, np.uint8))
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == want
        shared = suffix_arrays.common_prefixes(np.frombuffer(text, np.uint8), order, 50).tolist()
        for k in range(1, len(want)):
            a, b = text[want[k - 1] :][:50], text[want[k] :][:50]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def brute_repeats(docs, window=50):
    """Per row: bytes, kept bytes, removed spans."""
    out = []
    key = lambda d: float("inf") if d is None else d
    for doc_id, text in docs:
        data = (text or "").encode()
        smaller = set()
        for other, t in docs:
            if key(other) < key(doc_id):
                b = (t or "").encode()
                smaller.update(b[i : i + window] for i in range(len(b) - window + 1))
        gone = np.zeros(len(data) + 1, np.int8)
        for i in range(len(data) - window + 1):
            if data[i : i + window] in smaller:
                gone[i : i + window] = 1
        edges = np.diff(np.concatenate([[0], gone]))
        spans = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        out.append((doc_id, data, bytes(np.frombuffer(data, np.uint8)[gone[:-1] == 0]), spans))
    return sorted(out, key=repr)


def removed(docs):
    names = suffix_dedup.added_names(docs)
    assert names == ["__bytes", "__kept", "__spans"]  # the documents have such columns already
    return sorted(
        ((r["doc_id"], bytes(r[names[0]]), bytes(r[names[1]]), [tuple(s) for s in r[names[2]]]) for r in suffix_dedup.remove_repeats(docs).collect()),
        key=repr,
    )


@pytest.mark.parametrize("tasks", [1, 6])
def test_repeats_against_brute_force(spark, tasks):
    rng = random.Random(8)
    passages = [prose(rng, n, 50) for n in (8, 15, 40)] + ["é" * 40, "\0" * 60, "ab" * 60]
    docs = []
    for doc_id in rng.sample(range(500), 60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else prose(rng, rng.randrange(1, 30), 3000) for _ in range(rng.randrange(0, 5))]
        docs.append((doc_id, " ".join(parts)))
    docs += [(None, docs[3][1]), (docs[5][0], docs[5][1]), (600, "x" * 49), (601, "x" * 49), (602, "y" * 50), (603, "y" * 50), (604, None)]
    assert removed(frame(spark, docs).repartition(tasks)) == brute_repeats(docs)


def test_repeats_edge_rows(spark, empty):
    docs = [r for r in edge_rows() if r[0] != 8]
    assert removed(frame(spark, docs)) == brute_repeats(docs)
    assert suffix_dedup.remove_repeats(empty).count() == 0
    long = prose(random.Random(9), 400_000, 10**6)  # longer than a piece
    got = removed(frame(spark, [(1, long), (2, "q" + long[400_000:600_000]), (3, long[:200])]).repartition(3))
    assert [(g[0], len(g[2]), len(g[3])) for g in got] == [(1, len(long), 0), (2, 1, 1), (3, 0, 1)]


def brute_alignment(item, text):
    above = [0] * (len(text) + 1)
    best = 0
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, above[j] + (1 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def brute_contamination(docs, items):
    """Scores of all pairs that reach the least score and share an n-gram."""
    def grams_of(found, size):
        return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}

    out = {}
    for doc_id, text in docs:
        found = decontaminate.words(text or "")
        for item_id, item in items:
            want = decontaminate.words(item or "")
            size = min(decontaminate.GRAM, len(want))
            if want and grams_of(want, size) & grams_of(found, size):
                score = brute_alignment(want, found) / len(want)
                if score >= decontaminate.MIN_SCORE:
                    out[doc_id, item_id] = max(score, out.get((doc_id, item_id), 0))
    return out


def edited(rng, text, share):
    out = []
    for word in text.split():
        turn = rng.random()
        if turn < share / 3:
            out.append(f"n{rng.randrange(100)}")
        elif turn < 2 * share / 3:
            out += [word, f"n{rng.randrange(100)}"]
        elif turn >= share:
            out.append(word.upper() + ",")
    return " ".join(out)


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_contamination_against_brute_force(spark, block_words):
    rng = random.Random(10)
    items = [(i, prose(rng, rng.choice([6, 20, 45]), 300)) for i in range(12)] + [(50, None), (51, "!!"), (52, "two words"), (None, prose(rng, 25, 300))]
    docs = [(i, prose(rng, rng.randrange(0, 200), 300)) for i in range(20)]
    for i in range(20, 70):
        item = rng.choice(items[:12])[1]
        docs.append((i, " ".join([prose(rng, rng.randrange(60), 300), edited(rng, item, rng.choice([0, 0.1, 0.2])), prose(rng, rng.randrange(60), 300)])))
    docs += [(100, None), (101, ""), (102, "these two words"), (None, items[0][1]), (20, docs[20][1]), (103, items[-1][1])]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, score string")
    found = decontaminate.contaminated(frame(spark, docs).repartition(3), benchmark, block_words=block_words)
    assert {(r["doc_id"], r["item_id"]): pytest.approx(r["score"]) for r in found.collect()} == brute_contamination(docs, items)


def test_an_edit_or_a_part_that_leaked_often(spark):
    """More than half of the item's n-grams are in no document, the others are in many."""
    rng = random.Random(11)
    items = [(i, " ".join(f"i{i}x{k}" for k in range(60))) for i in range(3)]
    edit = " ".join("other" if k % 5 == 4 else w for k, w in enumerate(items[0][1].split()))
    part = " ".join(items[1][1].split()[:30])
    short = " ".join(items[2][1].split()[:20])  # below the least score
    docs = [(i, " ".join([prose(rng, 20), (edit, part, short)[i % 3], prose(rng, 20)])) for i in range(150)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_contamination(docs, items)
    assert len(want) == 100
    found = decontaminate.contaminated(frame(spark, docs).repartition(3), benchmark)
    assert {(r["doc_id"], r["item_id"]): pytest.approx(r["score"]) for r in found.collect()} == want


def test_shards_merged_in_groups(spark, monkeypatch):
    """Shards of a few kilobytes, two at a time: what a group of shards leaves is merged again."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 4000)
    rng = random.Random(18)
    shared = [prose(rng, 14) for _ in range(6)]
    docs = [(i, f"{prose(rng, rng.randrange(30))} {rng.choice(shared)} {prose(rng, rng.randrange(30))}") for i in range(150)]
    names = ["_bytes", "_kept", "_spans"]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = [
        sorted((r["doc_id"], bytes(r[names[1]]), [tuple(s) for s in r[names[2]]]) for r in suffix_dedup.remove_repeats(frames, shards=shards).collect())
        for shards in (2, 4096)
    ]
    assert got[0] == got[1] == sorted((d, kept, spans) for d, _, kept, spans in brute_repeats(docs))


def block_of(block, docs):
    return pa.table({"doc_id": [d for d, _ in docs], "_row": [hash((block, d)) % 2**32 for d, _ in docs], "_bytes": [t.encode() for _, t in docs], "_block": pa.array([block] * len(docs), pa.int32())})


def marks_of(blocks, bits):
    """What the parts of the names answer."""
    namer = suffix_dedup.namer("_row", "_bytes", "_block", 50, bits)
    return pa.concat_tables([suffix_dedup.mark(group) for group in split_by(pa.concat_tables([namer(b) for b in blocks]), "part")])


def split_by(table, column):
    for value in sorted(set(table.column(column).to_pylist())):
        yield table.filter(pc.equal(table.column(column), value))


@pytest.mark.parametrize("bits", [4, 9])
def test_a_window_is_marked_if_another_document_has_its_name(bits):
    """Exactly then, in whatever block the other document is and however many names there are."""
    rng = random.Random(20)
    shared = [prose(rng, 30, 10**6) for _ in range(5)]
    texts = [" ".join([prose(rng, 60, 10**6), rng.choice(shared) if rng.random() < 0.5 else "", prose(rng, 20, 10**6)]) for _ in range(120)]
    blocks = [block_of(b, [(i, t) for i, t in enumerate(texts) if i % 4 == b]) for b in range(4)] + [block_of(4, [(900, ""), (901, "short")])]
    marks = marks_of(blocks, bits)
    found = [list(suffix_dedup.pieces(b, "_row", "_bytes", 50)) for b in blocks]
    uses = Counter(k for pieces in found for p in pieces for k in set(p.key.tolist()))
    assert 0 < sum(n > 1 for n in uses.values()) < len(uses) / 4
    for at, pieces in enumerate(found[:4]):
        hits = suffix_dedup.marked(pieces, marks.filter(pc.equal(marks.column("block"), at)), bits)
        for piece, hit in zip(pieces, hits):
            assert hit.tolist() == [uses[k] > 1 for k in piece.key.tolist()]


def test_a_block_sends_a_part_one_packet(monkeypatch):
    """However many shards the block has; before, each shard sent each part a packet."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 20_000)
    rng = random.Random(21)
    docs = [(i, prose(rng, 200, 10**6)) for i in range(100)]
    blocks = [block_of(0, docs), block_of(1, docs)]
    marks = marks_of(blocks, 4)
    sharder = suffix_dedup.sharder("_row", "_bytes", "_block", 50, 4, 8, 2, 1)
    got = sharder(blocks[0], marks.filter(pc.equal(marks.column("block"), 0)))
    sent = [(r["kind"], r["part"]) for r in got.to_pylist()]
    assert sorted(sent) == [(suffix_dedup.SEGMENTS, p) for p in range(8)]
    assert sum(len(t) for _, t in docs) > 5 * suffix_dedup.SHARD_BYTES


def test_repeats_shuffle_the_documents_once(spark):
    """The three steps that read the documents share one shuffle, and nothing is broadcast."""
    rng = random.Random(22)
    docs = spark.createDataFrame([(i, prose(rng, 30)) for i in range(50)], "doc_id bigint, text string")
    got = suffix_dedup.remove_repeats(docs)
    assert len(got.collect()) == 50
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2 and "Broadcast" not in plan


def test_a_common_phrase_does_not_pair_all(spark):
    """2000 items and 2000 documents share one trigram; a few documents hold an item as well."""
    rng, phrase = random.Random(14), "which of the following"
    word = lambda: f"v{rng.randrange(20_000)}"
    items = [(i, f"{phrase} {' '.join(word() for _ in range(20))}") for i in range(2000)]
    docs = [(i, f"{' '.join(word() for _ in range(40))} {phrase} {' '.join(word() for _ in range(40))}") for i in range(1990)]
    docs += [(5000 + i, f"{word()} {edited(rng, items[i][1], 0.1)} {word()}") for i in range(10)]
    block = next(decontaminate.item_blocks(spark.createDataFrame(items, "item_id bigint, text string")))
    rarest = decontaminate.rare_words(block, decontaminate.MIN_SCORE)
    assert sum(len(rarest.candidates(block.read(t))) for _, t in docs) < 3 * len(docs)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(frame(spark, docs).repartition(4), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(5000 + i, i) for i in range(10)}


def test_rare_words_leave_no_match_out():
    """Whatever an alignment matches, enough of the item's rarest words are among it."""
    rng = random.Random(15)
    items = [np.array([rng.randrange(1, 40) for _ in range(rng.randrange(1, 30))]) for _ in range(60)]
    block = decontaminate.ItemBlock(list(range(60)), items, {f"w{i}": i for i in range(1, 40)})
    rarest = decontaminate.rare_words(block, 0.5)
    for _ in range(400):
        owner = rng.randrange(60)
        item = items[owner]
        kept = np.array(rng.sample(range(len(item)), max(1, -(-len(item) // 2))))
        document = np.concatenate([item[np.sort(kept)], np.zeros(3, np.int64)])
        assert owner in rarest.candidates(document)


def test_copies_of_a_text_spread_over_all_parts(spark):
    """A third of the rows have one text; they are dealt by doc_id as well."""
    rng = random.Random(16)
    same = prose(rng, 30)
    docs = frame(spark, [(i, same if i % 3 == 0 else prose(rng, 10)) for i in range(3000)])
    data = F.col("text").cast("binary")
    parts = docs.select(F.pmod(F.xxhash64(F.col("doc_id"), data), F.lit(1 << 32)).alias("row")).groupBy((F.col("row") % 16).alias("p")).count()
    assert parts.agg(F.max("count")).first()[0] < 2 * 3000 / 16
    got = suffix_dedup.remove_repeats(docs.select("doc_id", "text"))
    shared = got.where(F.col("_bytes") == F.lit(same.encode())).select(F.octet_length("_kept").alias("n"), "doc_id").collect()
    assert {r["doc_id"] for r in shared if r["n"]} == {0} and len(shared) == 1000


def test_contamination_edge_rows(spark, edges, empty):
    benchmark = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert decontaminate.contaminated(empty, benchmark).count() == 0
    assert decontaminate.contaminated(edges, benchmark.where("false")).count() == 0
    assert [tuple(r) for r in decontaminate.contaminated(edges, benchmark).collect()] == [(9, 1, 0.5, 2)]
