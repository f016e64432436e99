"""Operators over GPS points: trips, positions, active orders, hourly counts.

Points carry ``driver_id, order_id, ts, lng, lat, is_end``; an end row marks the
close of a trip and is no position. Every function is a plain aggregation with
map-side partials and runs on a streaming frame as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions import text as txt


def positions(points: DataFrame) -> DataFrame:
    return points.where(~F.col("is_end"))


def _spot(pick, name: str) -> Column:
    return pick(F.struct("ts", "lng", "lat")).alias(name)


def trip_state(points: DataFrame, city_code: str = txt.CITY_PREFIX) -> DataFrame:
    """First and last point of every trip with their times."""
    trips = positions(points).groupBy("order_id").agg(_spot(F.min, "on"), _spot(F.max, "off"))
    return trips.select(
        F.lit(city_code).alias("city_code"),
        "order_id",
        F.col("on.ts").alias("start_time"),
        F.col("off.ts").alias("end_time"),
        F.col("on.lng").alias("get_on_lng"),
        F.col("on.lat").alias("get_on_lat"),
        F.col("off.lng").alias("get_off_lng"),
        F.col("off.lat").alias("get_off_lat"),
    )


def closed_trips(points: DataFrame, idle: str = "6 hours", city_code: str = txt.CITY_PREFIX) -> DataFrame:
    """Trips that are over: one second after their end marker, or ``idle`` after their last event.

    On a stream with a watermark a trip is given out once, when the watermark has
    passed its closing time, and its state is dropped; an event that comes later
    begins a new trip of the order. On a batch all trips are given out.
    """
    span = F.session_window("ts", F.when(F.col("is_end"), F.lit("1 second")).otherwise(F.lit(idle)))
    point = F.when(~F.col("is_end"), F.struct("ts", "lng", "lat"))
    trips = points.groupBy(span.alias("span"), "order_id").agg(
        F.min(point).alias("on"), F.max(point).alias("off"), F.bool_or("is_end").alias("has_end"), F.count(point).alias("n_points"),
    )
    return trips.select(
        F.lit(city_code).alias("city_code"), "order_id", F.col("on.ts").alias("start_time"), F.col("off.ts").alias("end_time"),
        F.col("on.lng").alias("get_on_lng"), F.col("on.lat").alias("get_on_lat"),
        F.col("off.lng").alias("get_off_lng"), F.col("off.lat").alias("get_off_lat"),
        "has_end", "n_points", F.col("span.end").alias("closed_at"),
    )


def order_activity(points: DataFrame) -> DataFrame:
    """Newest event, number of points and whether the order is still running.

    At equal times an end counts as the later event. Only fixed-width values are
    aggregated, so partial results stay in a hash table.
    """
    state = points.groupBy("order_id").agg(
        F.max("ts").alias("last_ts"), F.max(F.when(F.col("is_end"), F.col("ts"))).alias("last_end"),
        F.count_if(~F.col("is_end")).alias("n_points"),
    )
    running = F.coalesce(F.col("last_end") < F.col("last_ts"), F.lit(True)) & (F.col("n_points") > 0)
    return state.select("order_id", "last_ts", "n_points", running.alias("is_active"))


def active_orders(points: DataFrame, city_code: str = txt.CITY_PREFIX) -> DataFrame:
    """Orders whose newest event is not an end and that have at least one point."""
    return active_of(order_activity(points), city_code)


def active_of(activity: DataFrame, city_code: str = txt.CITY_PREFIX) -> DataFrame:
    key = F.concat(F.lit(f"{city_code}_"), F.col("order_id"))
    return activity.where("is_active").select(key.alias("order_key"), "n_points")


def orders_of_city(orders: DataFrame, city_code: str) -> DataFrame:
    return orders.where(F.col("order_key").startswith(f"{city_code}_"))


def last_position(points: DataFrame) -> DataFrame:
    spot = positions(points).groupBy("order_id").agg(_spot(F.max, "p"))
    return spot.select("order_id", F.col("p.ts").alias("ts"), F.col("p.lng").alias("lng"), F.col("p.lat").alias("lat"))


def first_position(points: DataFrame) -> DataFrame:
    """Oldest unread point: what a replay of the queue shows first."""
    spot = positions(points).groupBy("order_id").agg(_spot(F.min, "p"))
    return spot.select("order_id", F.col("p.ts").alias("ts"), F.col("p.lng").alias("lng"), F.col("p.lat").alias("lat"))


def queue_entries(points: DataFrame) -> DataFrame:
    """Queue text of every event: ``lng,lat`` or the closing marker."""
    entry = F.when(F.col("is_end"), F.lit("end")).otherwise(
        F.concat_ws(",", F.col("lng").cast("string"), F.col("lat").cast("string"))
    )
    return points.select("order_id", "ts", "is_end", entry.alias("entry"))


def position_queue(points: DataFrame, bucket: str = "minute") -> DataFrame:
    """Every queue entry with its index, newest first (index 0).

    Ranks are taken inside (order, time bucket) and shifted by the sizes of the
    later buckets, so a huge order is ranked by many tasks. Only the counts per
    bucket, bounded by the trip's duration, meet in one window group.
    """
    rows = queue_entries(points).withColumn("bucket", F.date_trunc(bucket, "ts"))
    sizes = rows.groupBy("order_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    later = Window.partitionBy("order_id").orderBy(F.col("bucket").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select("order_id", "bucket", F.coalesce(F.sum("n").over(later), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("order_id", "bucket").orderBy(
        F.col("ts").desc(), F.col("is_end").desc(), F.col("entry").desc()
    )
    ranked = rows.withColumn("rank", F.row_number().over(inside))
    placed = ranked.join(offsets, ["order_id", "bucket"])
    return placed.select("order_id", "ts", "entry", (F.col("skip") + F.col("rank") - 1).alias("queue_index"))


def replay(points: DataFrame) -> DataFrame:
    """Queue entries ordered per order and time; range partitions split a huge order."""
    return queue_entries(points).repartitionByRange("order_id", "ts").sortWithinPartitions("order_id", "ts")


def hourly_order_counts(points: DataFrame) -> DataFrame:
    """Every order once, in the hour of its first point."""
    first = positions(points).groupBy("order_id").agg(F.min("ts").alias("first_ts"))
    return first.groupBy(F.date_trunc("hour", "first_ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("order_count")
    )


def daily_order_counts(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(F.to_date("hour").alias("day")).agg(F.sum("order_count").alias("order_count"))


def track_of_trips(points: DataFrame, trips: DataFrame, inclusive: bool = True) -> DataFrame:
    """Points within the times of their trip; ``inclusive=False`` drops the first instant."""
    times_of = trips.select("order_id", "start_time", "end_time")
    joined = positions(points).join(times_of, "order_id")
    after_start = F.col("ts") >= F.col("start_time") if inclusive else F.col("ts") > F.col("start_time")
    return joined.where(after_start & (F.col("ts") <= F.col("end_time"))).select(
        "order_id", "driver_id", "ts", "lng", "lat"
    )


def track_history(points: DataFrame, trips: DataFrame, order_key: str | None = None, inclusive: bool = True) -> DataFrame:
    """History track of one order (with or without city prefix), or of all orders."""
    if order_key is not None:
        bare = order_key.removeprefix(f"{txt.CITY_PREFIX}_")
        points = points.where(F.col("order_id") == bare)
        trips = trips.where(F.col("order_id") == bare)
    return track_of_trips(points, trips, inclusive)
