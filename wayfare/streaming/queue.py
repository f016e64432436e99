"""The queue of positions of every order, kept by a stream.

Entries are appended and never moved. They stand in segments of an order's time, and
beside them each batch notes how many entries it added to which segment. The index
of an entry, newest first, is the number of entries in later segments, a sum over
segment counts, plus its rank within its own: an order of any size is ranked by as
many tasks as it has segments, and the newest entries are read from the newest
segments alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.operators import tracks
from wayfare.sources.sinks import BATCH, FAN, RUN, WRITTEN, append_changes, fold_levels, read_changes, staged
from wayfare.streaming.jobs import TRIGGER_INTERVAL, batch_stream

#: Seconds of an order that one segment covers.
SEGMENT_SECONDS = 60
ENTRIES, COUNTS = "entries", "counts"


def segmented(points: DataFrame, seconds: int = SEGMENT_SECONDS) -> DataFrame:
    """Queue entries with the number of their segment."""
    entries = tracks.queue_entries(points)
    return entries.withColumn("segment", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / seconds))


def start_position_queue(
    points: DataFrame, out: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL, seconds: int = SEGMENT_SECONDS, fan: int = FAN
) -> StreamingQuery:
    """Append a stream of points to the queues. A batch that is replayed replaces itself in both tables."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staged(batch, segmented(batch, seconds), out, batch_id) as entries:
            append_changes(entries, f"{out}/{ENTRIES}", batch_id)
            counts = entries.groupBy("order_id", "segment").agg(F.count(F.lit(1)).alias("n"))
            append_changes(counts, f"{out}/{COUNTS}", batch_id)
        for name in (ENTRIES, COUNTS):
            fold_levels(spark, f"{out}/{name}", fan=fan)

    return batch_stream(points, write, checkpoint, "position_queue", "append", interval)


def _segments(spark: SparkSession, out: str, order_id: str | None) -> DataFrame:
    """Entries of each segment, and entries in later segments of the order (``skip``)."""
    counts = read_changes(spark, f"{out}/{COUNTS}")
    if order_id is not None:
        counts = counts.where(F.col("order_id") == order_id)
    sizes = counts.groupBy("order_id", "segment").agg(F.sum("n").alias("n"))
    later = Window.partitionBy("order_id").orderBy(F.col("segment").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("skip", F.coalesce(F.sum("n").over(later), F.lit(0)))


def read_queue(spark: SparkSession, out: str, order_id: str | None = None, newest: int | None = None) -> DataFrame:
    """order_id, ts, entry, queue_index (0 is the newest) of all orders or one; with ``newest`` the first so many of each."""
    segments = _segments(spark, out, order_id)
    entries = read_changes(spark, f"{out}/{ENTRIES}").drop(RUN, BATCH, WRITTEN)
    if order_id is not None:
        entries = entries.where(F.col("order_id") == order_id)
    if newest is not None:  # later segments hold enough entries already
        segments = segments.where(F.col("skip") < newest)
    inside = Window.partitionBy("order_id", "segment").orderBy(F.col("ts").desc(), F.col("is_end").desc(), F.col("entry").desc())
    ranked = entries.join(segments.select("order_id", "segment", "skip"), ["order_id", "segment"]).withColumn("place", F.row_number().over(inside) - 1)
    placed = ranked.select("order_id", "ts", "entry", (F.col("skip") + F.col("place")).alias("queue_index"))
    return placed if newest is None else placed.where(F.col("queue_index") < newest)
