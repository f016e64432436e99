"""Streaming jobs: ingest, live state, change apply.

Sinks are idempotent: the file sink keeps its own log, and ``foreachBatch``
writers know a batch by its run and number. Their tables fold ``fan`` batches into one
part, ``fan`` of these into one again and so on, so what a reader opens hardly grows.
State is unbounded by default (an order counts once for ever);
``watermark`` bounds it on request.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.functions import keys as rowkeys
from wayfare.operators import tracks
from wayfare.sources.sinks import FAN, append_changes, fold_levels, read_current, staged
from wayfare.streaming import cdc, lines

GPS_TOPIC = "gps"
ORDER_TOPIC = "orders"
TRIGGER_INTERVAL = "5 seconds"


def _trigger(writer, interval: str | None):
    """A processing-time trigger, or everything available once when no interval is given."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def append_stream(df: DataFrame, path: str, checkpoint: str, name: str, interval: str | None = TRIGGER_INTERVAL) -> StreamingQuery:
    writer = (
        df.writeStream.queryName(name).outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, interval).start()


def batch_stream(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name: str, mode: str, interval: str | None = TRIGGER_INTERVAL) -> StreamingQuery:
    writer = df.writeStream.queryName(name).outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def start_ingest(records: DataFrame, out: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL, fan: int = FAN) -> StreamingQuery:
    """One source, read once, and two tables: position rows and order rows, split by topic."""
    topics = {"gps": (GPS_TOPIC, lines.gps_rows), "orders": (ORDER_TOPIC, lines.order_rows)}

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged(batch, batch.select("topic", "value"), out, batch_id) as routed:
            for name, (topic, rows) in topics.items():
                append_changes(rows(lines.of_topic(routed, topic).select("value")), f"{out}/{name}", batch_id)
                fold_levels(batch.sparkSession, f"{out}/{name}", fan=fan)

    return batch_stream(records, write, checkpoint, "ingest", "append", interval)


def start_routed_ingest(records: DataFrame, out: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL, fan: int = FAN) -> StreamingQuery:
    """One query that routes by content: good rows to two tables, bad lines to quarantine."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged(batch, batch.select("value"), out, batch_id) as values:
            good, bad = lines.quarantine(values)
            routed = {"gps": lines.gps_rows(good), "orders": lines.order_rows(good), "quarantine": bad}
            for name, rows in routed.items():
                append_changes(rows, f"{out}/{name}", batch_id)
                fold_levels(batch.sparkSession, f"{out}/{name}", fan=fan)

    return batch_stream(records, write, checkpoint, "routed_ingest", "append", interval)


def start_state(
    state: DataFrame, out: str, checkpoint: str, name: str, mode: str = "update", interval: str | None = TRIGGER_INTERVAL,
    keys: list[str] | None = None, fan: int = FAN,
) -> StreamingQuery:
    """Keep a keyed state table: each batch appends the keys that changed; with ``keys`` folds keep the newest image of each."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, out, batch_id)
        fold_levels(batch.sparkSession, out, keys, fan=fan)

    return batch_stream(state, write, checkpoint, name, mode, interval)


def bounded(points: DataFrame, watermark: str | None) -> DataFrame:
    return points.withWatermark("ts", watermark) if watermark else points


def first_seen(points: DataFrame) -> DataFrame:
    """First event time of every order; independent of arrival order."""
    return tracks.positions(points).groupBy("order_id").agg(F.min("ts").alias("first_ts"))


def hourly_first_processed(points: DataFrame, watermark: str | None = None) -> DataFrame:
    """Orders per hour of the point that was processed first.

    Without a watermark every order id stays in state and the totals are exact
    (complete mode); with one, ids and hours are forgotten behind it.
    """
    once = tracks.positions(bounded(points, watermark))
    once = once.dropDuplicatesWithinWatermark(["order_id"]) if watermark else once.dropDuplicates(["order_id"])
    counts = once.groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("order_count"))
    return counts.select(F.col("window.start").alias("hour"), "order_count")


def start_trip_closing(
    points: DataFrame, out: str, checkpoint: str, watermark: str = "1 hour", idle: str = "6 hours", interval: str | None = TRIGGER_INTERVAL
) -> StreamingQuery:
    """Write every trip once, when it is over; state holds running trips alone.

    Events that come more than ``watermark`` after later ones were seen are dropped.
    """
    return append_stream(tracks.closed_trips(bounded(points, watermark), idle), out, checkpoint, "trip_closing", interval)


def start_cdc(
    messages: DataFrame, out: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL, compact_every: int = FAN,
    deletes: str = "keep",
) -> StreamingQuery:
    """Apply change envelopes: per batch, the newest image of every id and entity under its salted key, and what is unusable.

    ``compact_every`` parts of one level are folded into one. With ``deletes`` set to
    "ignore" deletes are not applied; with "drop" they are, as images that
    ``read_applied`` leaves out.
    """
    if deletes not in cdc.DELETE_MODES:
        raise ValueError(f"unknown delete mode {deletes!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staged(batch, cdc.with_reason(batch), out, batch_id) as marked:
            good, bad = cdc.split(marked)
            append_changes(bad, f"{out}/quarantine", batch_id)
            fold_levels(spark, f"{out}/quarantine", fan=compact_every)
            for entity in cdc.TABLE_COLUMNS:
                images = cdc.newest_images(cdc.entity_rows(good, entity), "ignore" if deletes == "ignore" else "keep")
                append_changes(images.select(rowkeys.salted_key(F.col("id")).alias("rowkey"), "*"), f"{out}/{entity}", batch_id)
        for entity in cdc.TABLE_COLUMNS:
            fold_levels(spark, f"{out}/{entity}", ["id"], ["ts", "offset"], compact_every)

    return batch_stream(messages, write, checkpoint, "cdc_apply", "append", interval)


def read_applied(spark: SparkSession, out: str, entity: str, deletes: str = "keep") -> DataFrame:
    """The table of one entity that ``start_cdc`` keeps, as its delete mode shows it."""
    current = read_current(spark, f"{out}/{entity}", ["id"], ["ts", "offset"])
    return current.where(F.col("op") != "delete") if deletes == "drop" else current


def wait(*queries: StreamingQuery) -> None:
    for query in queries:
        query.awaitTermination()
