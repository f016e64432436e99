"""Token counts, packing, archives and the pipeline: against the libraries and brute force."""

from __future__ import annotations

import gzip
import io
import random
import zipfile
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import rows
from tests.llm.conftest import edge_rows, frame, prose
from tests.llm.test_dedup_operators import brute_contamination, brute_groups, brute_repeats
from wayfare.llm import packing, token_counts, tokens, warc
from wayfare.session import scratch_path

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    "", " ", "  ", "a  b", "a\n b", "x <|endoftext|> y<|endoftext|>z <|startoftext|>", "a  b　c", "\x1c a\x1cb", "don't I'll 'S", "é ́x Å",
    "ΣΑΣ Σ", "a " * 50 + "\n\n  q\t", "日本語のテキスト 漢字", "x" * 5000, "tail  ", " lead", "ÀÿÖ!! ßa.,", "a­ b", "ªº µ", "a|b c||| d&&&", "1234 5a6 7.8", "İstanbul ŐŰ",
    "_a_ -b- (c) [d]", "a,b.c!", "mixed,. ..", "\r\n x\r\n",
]


@pytest.mark.parametrize("path, keep_blank", [(BYTE_BPE, True), (WORD_BPE, False)])
def test_units_give_the_librarys_ids(spark, data, path, keep_blank):
    texts = AWKWARD + [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect() if r["text"]]
    encoder, library = tokens.UnitEncoder(path, keep_blank, tokens.little_endian), tokens.load(path)
    for text in texts:
        assert b"".join(encoder.text(text)) == tokens.little_endian(library.encode(text, add_special_tokens=False).ids), text[:80]


def test_token_counts_and_cache(spark, edges, empty):
    cache, library = scratch_path(spark, "cache"), tokens.load(BYTE_BPE)
    want = sorted(((d, len((t or "").encode()), len(library.encode(t or "").ids), len(library.encode(t or "").ids) > 20) for d, t in edge_rows()), key=repr)
    assert rows(token_counts.token_counts(edges, BYTE_BPE, cache, 20)) == want
    digest = token_counts.tokenizer_digest(BYTE_BPE)
    stored = token_counts.read_cache(spark, cache, digest).count()
    assert stored == len({t or "" for _, t in edge_rows()})
    # a second run finds every count; another tokenizer finds none
    assert rows(token_counts.token_counts(edges, BYTE_BPE, cache, 20)) == want
    assert spark.read.parquet(cache).count() == stored
    assert token_counts.token_counts(edges, WORD_BPE, cache).count() == len(want) and spark.read.parquet(cache).count() == 2 * stored
    assert token_counts.token_counts(empty, BYTE_BPE, cache).count() == 0


def test_stored_counts_are_used(spark):
    cache, docs = scratch_path(spark, "cache"), frame(spark, [(1, "one two"), (2, "three")])
    digest = token_counts.tokenizer_digest(BYTE_BPE)
    known = docs.where("doc_id = 1").select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("content_digest"), F.lit(77).cast("long").alias("n_tokens"), F.lit(digest).alias("tokenizer_digest"))
    known.write.partitionBy("tokenizer_digest").parquet(cache)
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, BYTE_BPE, cache).collect()} == {1: 77, 2: 1}


def check_packing(found, docs, size):
    """Every piece of every document once, with its ids' checksum, and gapless sequences; returns their number."""
    library, want, spans = tokens.load(WORD_BPE), Counter(), defaultdict(list)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            want[doc_id, piece, at, len(part), zlib.crc32(tokens.little_endian(part))] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    for r in found:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for taken in spans.values():
        at = 0
        for offset, length in sorted(taken):
            assert offset == at
            at += length
        assert at <= size
    return len(spans)


def test_packing(spark, edges, empty):
    rng = random.Random(11)
    docs = edge_rows() + [(100 + i, prose(rng, rng.randrange(40))) for i in range(300)] + [(500 + i, "same text") for i in range(200)]
    found = packing.pack(frame(spark, docs).repartition(3), WORD_BPE, size=64).collect()
    total = sum(r["length"] for r in found)
    assert check_packing(found, docs, 64) <= -(-total // 64) + 2
    assert packing.pack(empty, WORD_BPE).count() == 0


def test_ranks_are_gapless_with_any_number_of_buckets(spark):
    pieces = spark.createDataFrame([(i % 50, i % 3, 0, 1 + i % 4, 0) for i in range(500)], packing.PIECES)
    for buckets in (1, 7):
        found = packing.ranked(pieces, buckets).groupBy("length").agg(F.sort_array(F.collect_list("rank")).alias("r"), F.count("*").alias("n")).collect()
        assert all(r["r"] == list(range(r["n"])) for r in found)


def brute_best_fit(lengths, size):
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= length
        else:
            room.append(size - length)
    return len(room)


def test_plan_equals_best_fit_decreasing():
    rng = random.Random(12)
    for size in (10, 64, 1000):
        for _ in range(20):
            lengths = [min(size, 1 + int(rng.expovariate(1 / (size / 4)))) for _ in range(rng.randrange(1, 400))]
            plan = packing.plan_slots(Counter(lengths), size)
            placed, spans = Counter(), defaultdict(list)
            for length, a, b, first, at, each in plan:
                for rank in range(a, b):
                    placed[length] += 1
                    spans[first + (rank - a) // each].append((at + (rank - a) % each * length, length))
            assert placed == Counter(lengths)
            for taken in spans.values():
                at = 0
                for offset, length in sorted(taken):
                    assert offset == at
                    at += length
                assert at <= size
            assert len(spans) == brute_best_fit(lengths, size)


def page_frame(spark, rows_):
    return spark.createDataFrame([(*r, "x", "x") for r in rows_], "page_id bigint, url string, html string, digest string, keeper string")


PAGES = [
    (1, "http://a/é?x=1\n2", "<p>one</p>"), (2, None, "<p>one</p>"), (9, "http://b", "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", "ü\r\n\r\nWARC/1.1\r\n"),
    (None, "u", "<p>alone</p>"), (None, "u", "<p>one</p>"), (7, "u", "z" * 300_000), (7, "u", "z" * 300_000),
]


def test_archives_round_trip(spark):
    folder = scratch_path(spark, "warc")
    packages = warc.write_packages(page_frame(spark, PAGES).repartition(2), folder, package_bytes=200)
    found = warc.read_packages(packages, folder)
    got = sorted(((r["page_id"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"], r["payload"] and bytes(r["payload"])) for r in found.collect()), key=repr)
    keeper = {"<p>one</p>": 9, "": 4, "z" * 300_000: 7, PAGES[5][2]: 5, "<p>alone</p>": None}
    want = []
    for page, _, html in PAGES:
        data, kept = (html or "").encode(), keeper[html or ""]
        revisit = kept is not None and page != kept
        want.append((page, "revisit" if revisit else "response", len(data), warc.payload_digest(data), kept if revisit else None, None if revisit else data or b""))
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want, key=repr)]
    assert {g[5] for g in got if g[5]} == {w[5] for w in want if w[5]}
    assert packages.agg(F.sum("records")).first()[0] == len(PAGES) and packages.count() > 2


def test_small_payloads_are_never_revisits(spark):
    folder = scratch_path(spark, "warc")
    packages = warc.write_packages(page_frame(spark, PAGES), folder, min_revisit_bytes=1000)
    kinds = Counter((r["payload_bytes"], r["record_type"]) for r in warc.read_packages(packages, folder).collect())
    assert kinds[10, "response"] == 4 and kinds[0, "response"] == 2 and not kinds[10, "revisit"]


def test_archives_of_no_pages(spark):
    folder = scratch_path(spark, "warc")
    packages = warc.write_packages(page_frame(spark, PAGES).where("false"), folder)
    assert warc.read_packages(packages, folder).count() == 0


def written_package(path):
    writer = warc.PackageWriter(pa.fs.LocalFileSystem(), path)
    for page in range(5):
        writer.add(page, "http://x", f"page {page}".encode(), None)
    writer.close()


def test_package_is_plain_zip_gzip_and_warc(tmp_path):
    path = str(tmp_path / "p.zip")
    written_package(path)
    with zipfile.ZipFile(path) as package:
        assert package.testzip() is None and {i.compress_type for i in package.infolist()} == {zipfile.ZIP_STORED}
        whole = gzip.decompress(package.read(warc.ARCHIVE))
        assert whole.count(b"WARC/1.1\r\nWARC-Type: response") == 5
        members = warc.zip_members(pa.BufferReader(open(path, "rb").read()))
        for info in package.infolist():
            assert members[info.filename].size == info.file_size
            data = open(path, "rb").read()[members[info.filename].start :][: info.file_size]
            assert data == package.read(info.filename)


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
        package.writestr("a", b"x" * 100)
        package.writestr("b", b"y" * 50)
        package.comment = b"a note"
    data = out.getvalue()
    assert warc.END64_RECORD in data
    members = warc.zip_members(pa.BufferReader(data))
    assert {n: data[m.start : m.start + m.size] for n, m in members.items()} == {"a": b"x" * 100, "b": b"y" * 50}


def test_compressed_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("a", b"x" * 100)
    with pytest.raises(ValueError):
        warc.zip_members(pa.BufferReader(out.getvalue()))


def as_rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_pipeline_stages_against_brute_force(spark, data, tmp_path):
    rng = random.Random(13)
    source = [r for r in spark.read.parquet(f"{data}/documents.parquet").where("n_chars < 3000").collect()][:60]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    made = [(r["doc_id"], r["text"], r["lang"]) for r in source]
    top = max(m[0] for m in made)
    for i in range(12):  # near copies, leaks, shared passages, junk
        words = source[i]["text"].split(" ")
        words[rng.randrange(len(words))] = "changed"
        made.append((top + 1 + i, " ".join(words), source[i]["lang"]))
        made.append((top + 101 + i, f"{source[20 + i]['text'][:200]} {items[i][1]}", source[20 + i]["lang"]))
        made.append((top + 201 + i, f"own start {i} of this {source[40]['text'][:400]} end {i}", source[40]["lang"]))
    made += [(top + 300, None, None), (top + 301, "12 34 56 --", "en"), (top + 302, "", "de")]
    docs = frame(spark, made)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{data}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, steps[-1], folder)
        out.write.parquet(f"{folder}/{name}")
        steps.append(spark.read.parquet(f"{folder}/{name}"))
    assert all(s.columns == docs.columns for s in steps[:-1])
    known, grouped, cut, clean, packed = steps[1:]
    lettered = [m for m in made if any(c.isalpha() for c in m[1] or "")]
    assert sorted(as_rows(known)) == sorted(m[:2] for m in lettered)
    heads = {d for d, _, c in brute_groups(as_rows(known)) if d == c}
    assert sorted(as_rows(grouped)) == sorted(x for x in as_rows(known) if x[0] in heads) and len(heads) < len(lettered)
    kept = [(d, data_.decode("utf-8", "ignore") if spans else None) for d, _, data_, spans in brute_repeats(as_rows(grouped))]
    texts = dict(as_rows(grouped))
    want = [(d, texts[d] if t is None else t) for d, t in kept if t is None or t.strip(" \t\n\x0b\x0c\r")]
    assert sorted(as_rows(cut)) == sorted(want) and want != sorted(texts.items())
    assert cut.where("n_chars <> length(text)").count() == 0
    leaked = {d for d, _ in brute_contamination(as_rows(cut), items)}
    assert leaked and sorted(as_rows(clean)) == sorted(x for x in as_rows(cut) if x[0] not in leaked)
    check_packing(packed.collect(), as_rows(clean), 4096)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(corpus_pipeline.run(spark, folder).select(columns)) == rows(packed.select(columns))


def test_one_of_each_group_by_id_and_text(spark, data):
    """A doc_id with two texts, and null ids: of the copies of A one stays, and B and C are texts of their own."""
    rng = random.Random(17)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows_in = [(0, a), (1, b), (1, a), (None, a), (None, c), (None, c), (2, ""), (2, ""), (3, None)]
    kept = corpus_pipeline.keep_one_of_each_group(spark, frame(spark, rows_in), data)
    assert sorted(as_rows(kept), key=repr) == sorted([(0, a), (1, b), (None, c), (2, ""), (3, None)], key=repr)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_edge_rows_and_empty_tables(spark, data, edges, empty, name, stage):
    assert stage(spark, empty, data).count() == 0
    out = stage(spark, edges, data)
    out.collect()
    if name != "best_fit_packing":
        assert out.columns == edges.columns


def test_units_in_use_outlive_the_others(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_UNITS", 60)
    encoder, library, asked = tokens.UnitEncoder(WORD_BPE, False, tokens.little_endian), tokens.load(WORD_BPE), []
    merge = encoder.cache.merge
    encoder.cache.merge = lambda piece: asked.append(piece) or merge(piece)
    letters = "abcdefghijklmnopqrst"
    for n in range(100):
        text = "Often, " + " ".join(letters[n % 20] + letters[n // 20] + x + "." for x in letters)
        assert b"".join(encoder.text(text)) == tokens.little_endian(library.encode(text, add_special_tokens=False).ids)
    assert asked.count("often") == 1
    assert len(encoder.cache) + len(encoder.cache.older) <= 60 + 2 * 21 and len(encoder.cache.words) <= 60 + 21
