"""Lexical search, the tokenization automaton and token alignment: against brute force and the libraries."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tests.conftest import rows
from tests.llm.conftest import edge_rows, frame, prose
from tests.llm.test_token_operators import AWKWARD
from wayfare.llm import bpe_automaton, lexical_search, token_alignment, tokens

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


# ranked lexical search


def plain_terms(text: str | None) -> list[str]:
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs: list[tuple], items: list[tuple], top: int) -> list[tuple]:
    counts = [(d, Counter(plain_terms(t))) for d, t in docs if plain_terms(t)]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // length
            score = 0
            for term in set(plain_terms(text)):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if none else doc_id, -score) for rank, (score, none, doc_id) in enumerate(sorted(scored)[:top], 1)]
    return out


def items_frame(spark, items):
    return spark.createDataFrame([(*i, "x", "x", "x") for i in items], "item_id bigint, text string, doc_id string, score string, rank string")


def found(df) -> list[tuple]:
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


ITEMS = [(1, "One w1 w2 w3 w4 w5"), (2, "w1 W2 w3 W4 w9 漢字"), (3, None), (4, "--"), (5, "w1 w2 w3 w4 w5 w6 w7"), (None, "b c É"), (5, "w8 w8 w1"), (6, "nowhere")]


@pytest.mark.parametrize("block_terms, sample", [(300_000, 64), (8, 2), (1, 1)])
def test_search_of_edge_rows(spark, edges, block_terms, sample):
    got = lexical_search.search(edges, items_frame(spark, ITEMS), 50, block_terms, sample)
    assert found(got) == sorted(brute_search(edge_rows(), ITEMS, 50), key=repr)


def test_search_with_ties_and_many_documents(spark):
    rng = random.Random(2)
    base = prose(rng, 40, 30)
    docs = [(i, base if i % 3 == 0 else prose(rng, rng.randrange(0, 60), 60)) for i in range(400)]
    rng.shuffle(docs)
    items = [(i, prose(rng, 12, 40)) for i in range(30)] + [(100, base)]
    got = lexical_search.search(frame(spark, docs).repartition(7), items_frame(spark, items), 10, 100, 4)
    assert found(got) == sorted(brute_search(docs, items, 10), key=repr)


def test_search_of_nothing(spark, edges, empty):
    items = items_frame(spark, ITEMS)
    assert found(lexical_search.search(empty, items)) == found(lexical_search.search(edges, items.limit(0))) == []
    assert lexical_search.search(empty, items).schema["item_id"].dataType.simpleString() == "bigint"


def test_shared_sums_are_added_once():
    """Whole-number sums over the graph are the direct ones, with fewer additions where items share terms."""
    rng = random.Random(3)
    common = [{f"c{g}{i}".encode() for i in range(8)} for g in range(4)]
    items = [set().union(*rng.sample(common, 2), {f"own{n}".encode()}) for n in range(60)] + [set()]
    plan = lexical_search.share(items)
    assert plan.items == list(range(60)) and plan.n_atoms < len(plan.terms)
    gain = np.array([[rng.randrange(10**9) for _ in range(5)] for _ in plan.terms], float)
    atoms = np.zeros((plan.n_atoms, 5))
    np.add.at(atoms, plan.atom, gain)
    of = {t: g for t, g in zip(plan.terms, gain)}
    assert (plan.sums(atoms) == np.array([sum(of[t] for t in items[n]) for n in plan.items])).all()
    # six pairs of groups are left to make, and one addition per item for its own term
    assert plan.additions() <= 6 + 60 < sum(len(x) - 1 for x in items if x)


# tokenization automaton


def merged(word: str, merges: list[tuple[str, str]], end: str) -> list[str]:
    """Each merge in turn, from left to right."""
    parts = list(word[:-1]) + [word[-1] + end]
    for u, v in merges:
        out, at = [], 0
        while at < len(parts):
            if parts[at : at + 2] == [u, v]:
                out.append(u + v)
                at += 2
            else:
                out.append(parts[at])
                at += 1
        parts = out
    return parts


@pytest.mark.parametrize("end", ["", "$"])
def test_automaton_of_random_merges(end):
    """All words of up to seven letters, for vocabularies that also have merges of two equal tokens and merges that never happen."""
    rng = random.Random(4)
    for _ in range(40):
        labels, merges = ["a", "b", *([f"a{end}", f"b{end}"] if end else [])], []
        while len(merges) < 8:
            u, v = rng.choice(labels), rng.choice(labels)
            if (not end or not u.endswith(end)) and u + v not in labels:
                merges.append((u, v))
                labels.append(u + v)
        automaton = bpe_automaton.Automaton({label: at for at, label in enumerate(labels)}, merges, end)
        for size in range(1, 8):
            for letters in itertools.product("ab", repeat=size):
                word = "".join(letters)
                assert [labels[i] for i in automaton.word(word)] == merged(word, merges, end), (merges, word)


def test_automaton_refuses_what_it_cannot_read():
    ids = {"a": 0, "b": 1, "ab": 2, "aba": 3}
    with pytest.raises(ValueError):
        bpe_automaton.Automaton(ids, [("ab", "a"), ("a", "b")])  # a merge before its part
    with pytest.raises(ValueError):
        bpe_automaton.Automaton(ids, [("a", "b")]).word("abc")


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_automaton_gives_the_librarys_ids_and_texts(spark, data, path):
    tokenizer, library = bpe_automaton.AutomatonTokenizer(path), tokens.load(path)
    rng = random.Random(6)
    alphabet = "aaabbeehiinnoorsstttuAÉé'’.,!?012<|>中文́ \t\n"
    texts = AWKWARD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(500)] + ["a" * n for n in range(40)]
    texts += [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect() if r["text"]]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(tokenizer.encode(text), "<u4")
        assert got.tolist() == want, text[:80]
        assert tokenizer.decode(got) == library.decode(want, skip_special_tokens=False), text[:80]


def test_encoded_and_decoded_edge_rows(spark, edges, empty):
    library = tokens.load(WORD_BPE)
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in edge_rows()]
    want = sorted(((d, tokens.little_endian(i), library.decode(i, skip_special_tokens=False)) for (d, _), i in zip(edge_rows(), ids)), key=repr)
    encoded = bpe_automaton.encode(edges, WORD_BPE)
    got = [(r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in bpe_automaton.decode(encoded, WORD_BPE).collect()]
    assert sorted(got, key=repr) == want
    assert bpe_automaton.decode(bpe_automaton.encode(empty, WORD_BPE), WORD_BPE).collect() == []


# cross-tokenizer alignment


def ranges(token_bytes: list[bytes], ids: list[int]) -> list[tuple[int, int]]:
    ends = list(itertools.accumulate(len(token_bytes[i]) for i in ids))
    return list(zip([0, *ends], ends))


class Plain:
    """Both tokenizers on whole texts, and all pairs of tokens compared."""

    def __init__(self):
        self.a, self.b = tokens.load(BYTE_BPE), token_alignment.load_pieces(PIECES)
        self.a.encode_special_tokens = True
        self.a_bytes, self.b_bytes = token_alignment.byte_token_bytes(BYTE_BPE), token_alignment.piece_token_bytes(self.b)

    def ids(self, text: str | None) -> tuple[list[int], list[int]]:
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        same = b"".join(self.a_bytes[i] for i in a) == b"".join(self.b_bytes[i] for i in b) == (" " + text).encode()
        return (a, b) if same else ([], [])

    def overlaps(self, a: list[int], b: list[int]) -> list[tuple[int, int]]:
        of_b = ranges(self.b_bytes, b)
        return [(i, j) for i, (s, e) in enumerate(ranges(self.a_bytes, a)) for j, (t, f) in enumerate(of_b) if s < f and t < e]

    def groups(self, a: list[int], b: list[int]) -> list[tuple[int, int]]:
        at = {e: j for j, (_, e) in enumerate(ranges(self.b_bytes, b))}
        return [(i, at[e]) for i, (_, e) in enumerate(ranges(self.a_bytes, a)) if e in at]


WIDE = "".join(map(chr, [*range(1, 0x250), *range(0x2000, 0x2070), *range(0x300, 0x340), 0x3000, 0x4E2D, 0x1F600, 0xFEFF, 0x180E]))
ODD = ["a".join(WIDE), " ".join(WIDE), " " * 3000 + "x", "x <s> </s> <unk> <0x41>y", "▁a ▁", "a▁b", "\x00 z", "  two", "naïve café", "ﬁne ①", "tab\tand\r\nline"]


def brute_alignment(docs: list[tuple]) -> list[tuple]:
    plain = Plain()
    found, total = [], Counter()
    for doc_id, text in docs:
        a, b = plain.ids(text)
        cuts = plain.groups(a, b)
        links = [(a[i], b[j]) for i, j in cuts]
        text, at = [], (0, 0)
        for i, j in cuts:
            text.append(",".join(map(str, a[at[0] : i + 1])) + "|" + ",".join(map(str, b[at[1] : j + 1])))
            at = (i + 1, j + 1)
        found.append((doc_id, a, b, links, hashlib.sha256(";".join(text).encode()).hexdigest() if a else ""))
        total.update(links)
    highest: dict[int, int] = defaultdict(int)
    for (_, b), n in total.items():
        highest[b] = max(highest[b], n)
    return [
        (doc_id, len(a), len(b), len(links), len(links), sum(total[x] == highest[x[1]] for x in links), sum(total[x] for x in links), sha)
        for doc_id, a, b, links, sha in found
    ]


def test_alignment_counts(spark, data, edges, empty):
    docs = [(d, t) for d, t in edge_rows()] + [(100 + n, t) for n, t in enumerate(ODD + AWKWARD)]
    docs += [(r["doc_id"] + 1000, r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = token_alignment.alignment_counts(frame(spark, docs).repartition(5), BYTE_BPE, PIECES)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == sorted(brute_alignment(docs), key=repr)
    assert token_alignment.alignment_counts(empty, BYTE_BPE, PIECES).collect() == []


def test_overlaps_and_groups(spark):
    plain = Plain()
    texts = ODD + [t for t in AWKWARD if len(t) < 200] + ["unbelievable internationalization of préliminaires 日本語"]
    got = token_alignment.align(frame(spark, list(enumerate(texts))).repartition(2), BYTE_BPE, PIECES)
    for row in got.collect():
        a, b = plain.ids(texts[row["doc_id"]])
        packed = {n: np.frombuffer(row[n], "<u4").tolist() for n in got.columns[1:]}
        assert (packed["a_ids"], packed["b_ids"]) == (a, b)
        assert list(zip(packed["overlap_a"], packed["overlap_b"])) == plain.overlaps(a, b)
        assert list(zip(packed["group_a"], packed["group_b"])) == plain.groups(a, b)


def test_only_plain_byte_level_vocabularies_are_taken():
    with pytest.raises(ValueError):
        token_alignment.byte_token_bytes(WORD_BPE)


def test_places_cover_all_pairs_that_can_end_together():
    a, b = [b"a", b"ba", b"", b"c"], [b"ca", b"a", b"a", b"dc"]
    want = sorted(i * 4 + j for i, x in enumerate(a) for j, y in enumerate(b) if x and y and (x.endswith(y) or y.endswith(x)))
    assert token_alignment.suffix_pairs(a, b).tolist() == want
    plain = Plain()
    places = token_alignment.suffix_pairs(plain.a_bytes, plain.b_bytes)
    assert len(places) < sum(map(len, plain.a_bytes)) + sum(map(len, plain.b_bytes))


def test_best_pairs_with_ties():
    places = np.array([0 * 3 + 0, 0 * 3 + 1, 1 * 3 + 0, 2 * 3 + 0])
    assert token_alignment.best_of_b(np.array([5, 0, 5, 4]), places, 3).tolist() == [True, True, True, False]


def test_ids_are_spelled_in_one_table():
    a, b = np.array([0, 7, 50256, 12]), np.array([31999, 3, 0])
    group_a, group_b = np.array([1, 3]), np.array([0, 2])
    told = token_alignment.spelled_ids(50257, 32000)
    assert told.dtype.itemsize == 8 and len(told) == 2 * (50257 + 32000)
    assert token_alignment.group_texts(a, b, group_a, group_b, told, 50257) == b"0,7|31999;50256,12|3,0"


def test_no_list_of_byte_level_ids_is_made():
    plain, encoder = Plain(), token_alignment.PairEncoder(BYTE_BPE, PIECES)
    wanted = [plain.ids(t) for t in ODD]
    encoder.library.encode_ordinary = None
    assert [tuple(np.frombuffer(x, "<u4").tolist() for x in got) for got in encoder.texts(ODD)] == wanted
