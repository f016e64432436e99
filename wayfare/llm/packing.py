"""Best-fit packing, planned over a histogram of lengths.

The plan places lengths, not documents: its input is one count per length, its
output one row per run of equal placements, both bounded by the sequence length
whatever the number of documents. Documents then take the planned slots by their
rank within their length. Ranks come from hashed buckets, so that a length that
most documents share is numbered by many tasks.

Null and empty texts are one piece that holds the end id alone. Rows that repeat
are packed each for itself. Null doc_ids are carried along. Only doc_id and text
are read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import stored, text_of
from wayfare.llm.tokens import little_endian, worker_encoder

SEQUENCE_TOKENS = 4096
END_ID = 1
#: Rows of one length that one window group numbers, on average.
BUCKET_ROWS = 2000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cutter(path: str, size: int, end_id: int):
    """A function for mapInArrow: doc_id, text to the pieces of each document."""
    tail = little_endian([end_id])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, False, little_endian)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                units = encoder.text(text)
                units.append(tail)
                ids = b"".join(units)
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            doc_ids, pieces, starts, lengths, sums = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def plan_slots(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, end rank, first sequence, offset, pieces per sequence).

    Sequences with the same room left are kept as ranges. A length goes to the
    fullest sequences that hold it, as often as it fits into each, and opens new
    ones for the rest, exactly as if its pieces came one by one.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: (first sequence, count)
    levels: list[int] = []  # the rooms above, sorted
    plan, opened = [], 0

    def put(left: int, first: int, count: int) -> None:
        if left and count:
            if not room[left]:
                insort(levels, left)
            room[left].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            at = bisect_left(levels, length)
            if at < len(levels):
                left = levels[at]
                first, n = room[left].pop()
                if not room[left]:
                    levels.pop(at)
            else:
                left, first, n = size, opened, -(-(count - rank) // (size // length))
                opened += n
            each = left // length
            full = min(n, (count - rank) // each)
            if full:
                plan.append((length, rank, rank + full * each, first, size - left, each))
                rank += full * each
                put(left - each * length, first, full)
            if full < n:
                rest = count - rank
                if rest:
                    plan.append((length, rank, count, first + full, size - left, rest))
                    put(left - rest * length, first + full, 1)
                    rank, full = count, full + 1
                put(left, first + full, n - full)
    return plan


def ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """Adds ``rank``: a number from 0 among the pieces of a length, without gaps."""
    salted = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    sizes = salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(starts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("place"))


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a place for every piece."""
    spark = docs.sparkSession
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("t")).mapInArrow(cutter(tokenizer_path, size, end_id), PIECES)
    pieces = stored(cut, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``size`` rows
    plan = spark.createDataFrame(
        plan_slots(histogram, size), "length bigint, first_rank bigint, end_rank bigint, first_sequence bigint, at bigint, each bigint"
    )
    buckets = max(1, -(-max(histogram.values(), default=1) // BUCKET_ROWS))
    step = F.col("rank") - F.col("first_rank")
    # the plan's size is bounded by the sequence length, not by the number of documents
    placed = ranked(pieces, buckets).join(F.broadcast(plan), "length").where((F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (step % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
