"""One runnable query per operator, over whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.catalog import views as v
from wayfare.functions import geometry, hexgrid, keys, sqlfunctions, text, times
from wayfare.operators import joins, latest, periods, spatial, tracks
from wayfare.operators.counting import count_where, distinct_where
from wayfare.plans import batch, hot, partials, reports, rolling, serving, stations
from wayfare.session import scratch_path
from wayfare.sources import districts as district_source
from wayfare.sources import ranges, readers, schema, sinks, topics
from wayfare.streaming import cdc, jobs, lines, metrics, queue

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY, DRIVER_DAY, RENTER_DAY = v.ORDERS_AS_OF, v.DRIVERS_AS_OF, v.RENTERS_AS_OF
TRACK_KEY = "075_0_2024-01-01"
PAIRS = {
    "month": ("2024-01-01", RENTER_DAY), "week": ("2024-01-23", RENTER_DAY), "day": ("2024-01-29", RENTER_DAY),
}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _seconds(name: str):
    return F.date_format(name, times.SECOND_FORMAT).alias(name)


def _micros(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


# ---- sources ----

def _raw_orders(spark, d):
    return schema.null_as_empty(v.orders(spark, d).withColumn("close_gps_time", F.lit(None).cast("timestamp")))


@query
def scan_entity(spark, d):
    return readers.scan_entity(_raw_orders(spark, d), "order").withColumns({
        "create_time": F.date_format("create_time", times.SECOND_FORMAT),
        "close_gps_time": F.date_format("close_gps_time", times.SECOND_FORMAT),
    })


@query
def scan_driver(spark, d):
    raw = schema.null_as_empty(v.raw_like(v.drivers(spark, d), "driver"))
    return readers.scan_entity(raw, "driver").withColumn("create_time", F.date_format("create_time", times.SECOND_FORMAT))


@query
def scan_renter(spark, d):
    raw = schema.null_as_empty(v.raw_like(v.renters(spark, d), "renter"))
    typed = readers.scan_entity(raw, "renter")
    return typed.withColumns({c: F.date_format(c, times.SECOND_FORMAT) for c in ("create_time", "last_logon_time")})


@query
def scan_family_columns(spark, d):
    customer = v.table(spark, d, "customer")
    wide = customer.select(keys.record_map(customer.columns).alias("MM"))
    return readers.select_family(
        wide, "MM:c_custkey , MM:c_name, c_mktsegment , MM:no_such_cell",
        "id string, name string, segment string, absent string",
    )


@query
def null_as_empty(spark, d):
    return schema.null_as_empty(
        v.renters(spark, d).select("id", _seconds("create_time"), _seconds("last_logon_time"), "last_login_city")
    )


@query
def scan_key_range(spark, d):
    keyed = v.table(spark, d, "customer").select(keys.salted_key(F.col("c_name")).alias("rowkey"))
    ranged = readers.key_ranges(keyed, "rowkey", readers.salted_split_points())
    inner = readers.scan_key_range(ranged, "rowkey", "0002", "0006")
    return inner.groupBy("key_range").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("rowkey").alias("first_key"), F.max("rowkey").alias("last_key")
    )


@query
def scan_key_range_source(spark, d):
    """The same keys from a keyed table, one input partition per range of its keys."""
    path = scratch_path(spark, "key-ranges")
    keyed = v.table(spark, d, "customer").select(keys.salted_key(F.col("c_name")).alias("rowkey"))
    sinks.write_report(keyed, path, "rowkey", buckets=32)
    inner = readers.key_ranges(ranges.read_key_range(spark, path, "rowkey", "0002", "0006"), "rowkey", readers.salted_split_points())
    return inner.groupBy("key_range").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("rowkey").alias("first_key"), F.max("rowkey").alias("last_key")
    )


@query
def scan_station_orders(spark, d):
    return v.station_orders(spark, d)


@query
def source_counts(spark, d):
    return readers.source_counts({
        "order": v.orders(spark, d), "renter": v.renters(spark, d), "driver": v.drivers(spark, d),
    })


@query
def district_flatten(spark, d):
    return district_source.flatten_tree(v.district_documents(spark, d))


@query
def district_geojson(spark, d):
    flat = district_source.flatten_geojson(v.geojson_documents(spark, d))
    edges = spatial.district_edges(flat)
    return edges.select(
        "name",
        F.size("edges").alias("n_edges"),
        F.round(F.array_min(F.transform("edges", lambda e: e["x1"])), 4).alias("west"),
        F.round(F.array_max(F.transform("edges", lambda e: e["y1"])), 4).alias("north"),
    )


# ---- sinks and merges ----

@query
def report_write(spark, d):
    path = scratch_path(spark, "report")
    sinks.write_report(reports.completion_by_city(v.orders(spark, d), DAY), path, "city_name")
    return sinks.read_report(spark, path)


def _balance_changes(spark, d):
    base = v.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.lit("1900-01-01").alias("version"), F.lit(-1).cast("bigint").alias("seq"),
        F.col("c_acctbal").alias("amount"),
    )
    changes = v.table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.to_date("o_orderdate").cast("string").alias("version"),
        F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("amount"),
    )
    return base, changes


@query
def upsert_latest(spark, d):
    base, changes = _balance_changes(spark, d)
    return latest.upsert_latest(base, changes, ["id"], ["version", "seq"])


@query
def upsert_partial(spark, d):
    events = v.table(spark, d, "events")
    cells = events.select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("id"),
        F.col("event_id").alias("version"),
        *[F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in ("click", "purchase", "signup")],
    )
    empty = cells.select("id", F.lit(-1).cast("bigint").alias("version"), *[
        F.lit(None).cast("double").alias(k) for k in ("click", "purchase", "signup")
    ]).distinct()
    return latest.upsert_partial(empty, cells, ["id"], "version")


@query
def stringify_report(spark, d):
    return schema.stringify(reports.region_orders(v.orders(spark, d), DAY))


# ---- filters ----

def _ids(df: DataFrame) -> DataFrame:
    return df.select("id", _seconds("create_time"))


@query
def filter_day(spark, d):
    return _ids(periods.filter_period(v.orders(spark, d), "create_time", "day", DAY))


@query
def filter_week_any_year(spark, d):
    return _ids(periods.filter_period(v.orders(spark, d), "create_time", "week", DAY))


@query
def filter_week_iso_year(spark, d):
    return _ids(periods.filter_period(v.orders(spark, d), "create_time", "week", DAY, "iso_year"))


@query
def filter_month(spark, d):
    return _ids(periods.filter_period(v.orders(spark, d), "create_time", "month", DAY))


@query
def filter_quarter(spark, d):
    return _ids(periods.filter_period(v.orders(spark, d), "create_time", "quarter", DAY))


@query
def filter_year(spark, d):
    return _ids(periods.filter_period(v.orders(spark, d), "create_time", "year", DAY))


@query
def filter_effective(spark, d):
    return v.orders(spark, d).where(periods.effective(F.col("cancel").cast("string"))).select("id", "cancel")


@query
def filter_since(spark, d):
    return _ids(periods.filter_since(v.orders(spark, d), "create_time", "1999-06-01"))


@query
def cells_min_orders(spark, d):
    cells = spatial.with_cell(v.orders(spark, d), "open_lat", "open_lng", hexgrid.HOT_RES)
    return cells.groupBy("cell").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= 10)


@query
def null_default(spark, d):
    users = v.renters(spark, d).select("id", _seconds("create_time"), _seconds("last_logon_time"))
    return schema.null_default(users, {"create_time": "never", "last_logon_time": "none"})


@query
def region_rollup(spark, d):
    regions = v.orders(spark, d).groupBy(text.region4(F.col("begin_address_code")).alias("region"))
    return regions.agg(F.count(F.lit(1)).alias("n_orders")).select(
        "region", text.region6(F.col("region")).alias("code"), "n_orders"
    )


@query
def route_lines(spark, d):
    return lines.route_lines(v.mixed_lines(spark, d))


@query
def quarantine(spark, d):
    _, bad = lines.quarantine(v.mixed_lines(spark, d))
    return bad.select("value", "reason")


@query
def gps_query(spark, d):
    rows = lines.gps_rows(v.gps_lines(spark, d))
    return serving.gps_query(rows, "2024-01-05 00:00:00", "2024-01-20 23:59:59", "075")


@query
def gps_query_narrow(spark, d):
    return serving.gps_query(lines.gps_rows(v.gps_lines(spark, d)), city_code="075", narrow=True)


@query
def track_history(spark, d):
    points = v.points(spark, d)
    track = tracks.track_history(points, tracks.trip_state(points), inclusive=False)
    return track.select("order_id", "driver_id", _micros("ts"), "lng", "lat")


@query
def track_history_order(spark, d):
    """One order's track: its key reaches the scan of the points on both sides."""
    points = v.points(spark, d)
    track = tracks.track_history(points, tracks.trip_state(points), TRACK_KEY)
    return track.select("order_id", "driver_id", _micros("ts"), "lng", "lat")


# ---- joins ----

def _period_counts(df: DataFrame, key: str, as_of: str, name: str, column: str) -> DataFrame:
    kept = df.where(periods.Periods.of(as_of).during(name, F.col("create_time")))
    return kept.groupBy(key).agg(F.count(F.lit(1)).alias(column))


@query
def join_left_city(spark, d):
    rides = v.orders(spark, d)
    done = rides.where(periods.effective(F.col("cancel")))
    left = _period_counts(done, "city_name", DAY, "year", "effective")
    return left.join(_period_counts(rides, "city_name", DAY, "year", "total"), "city_name", "left")


@query
def join_left_chain(spark, d):
    registered = v.drivers(spark, d)
    frames = [_period_counts(registered, "register_city", DRIVER_DAY, n, n) for n in periods.NAMES]
    return reduce(lambda a, b: a.join(b, "register_city", "left"), frames).fillna(0)


@query
def join_left_driver(spark, d):
    rides = v.orders(spark, d)
    year = periods.Periods.of(DAY).during("year", F.col("create_time"))
    done = rides.where(year & periods.effective(F.col("cancel")))
    left = done.groupBy("driver_id", "driver_name").agg(F.count(F.lit(1)).alias("effective"))
    return left.join(_period_counts(rides, "driver_id", DAY, "year", "total"), "driver_id", "left")


@query
def join_full_region(spark, d):
    rides = v.orders(spark, d).withColumn("region", text.region4(F.col("begin_address_code")))
    by_day = periods.filter_period(rides, "create_time", "day", DAY)
    by_month = periods.filter_period(rides, "create_time", "month", DAY)
    vehicles = by_day.groupBy("region").agg(F.count_distinct("vehicle_license").alias("vehicles"))
    counts = by_month.groupBy("region").agg(F.count(F.lit(1)).alias("n_orders"))
    return vehicles.join(counts, "region", "full").fillna(0)


@query
def join_full_users(spark, d):
    users = v.renters(spark, d).withColumn("region", text.region4(F.col("last_login_city")))
    new = users.where(periods.on_day(F.col("create_time"), "2024-01-01"))
    active = users.where(periods.on_day(F.col("last_logon_time"), RENTER_DAY))
    left = new.groupBy("region").agg(F.count(F.lit(1)).alias("new_users"))
    right = active.groupBy("region").agg(F.count_distinct("id").alias("active_users"))
    return left.join(right, "region", "full").fillna(0)


@query
def join_full_cells(spark, d):
    def cells(day: str, name: str) -> DataFrame:
        rides = spatial.with_cell(
            v.orders(spark, d).where(periods.on_day(F.col("create_time"), day)),
            "open_lat", "open_lng", hexgrid.HOT_RES,
        )
        newest = spatial.latest_per_cell(rides, "create_time", "id", ["begin_address_code"])
        return newest.select("cell", F.col("begin_address_code").alias(name))

    return cells(DAY, "today_code").join(cells("1998-07-14", "before_code"), "cell", "full")


@query
def join_inner_scalar(spark, d):
    rides = v.orders(spark, d)
    month = periods.Periods.of(DAY).during("month", F.col("create_time"))
    return rides.agg(
        F.lit(1).alias("myid"), F.count(F.lit(1)).alias("total_orders"), F.count_if(month).alias("month_orders"),
        F.round(F.sum("pay_all"), 2).alias("income"),
    )


@query
def join_left_retention(spark, d):
    users = v.renters(spark, d)
    cohort = users.where(periods.on_day(F.col("create_time"), "2024-01-01")).select("id")
    active = users.where(periods.on_day(F.col("last_logon_time"), RENTER_DAY)).select(
        "id", F.lit(True).alias("seen")
    )
    return cohort.join(active, "id", "left").select("id", F.coalesce("seen", F.lit(False)).alias("retained"))


@query
def join_self_cell(spark, d):
    cells = spatial.with_cell(v.orders(spark, d).select("id", "open_lat", "open_lng"), "open_lat", "open_lng", 7)
    return spatial.cells_with_min_orders(cells, 10).select("id", "cell", "total")


@query
def join_point_in_polygon(spark, d):
    picked = spatial.representatives(v.station_orders(spark, d), 9)
    matched = spatial.match_districts(picked, v.districts(spark, d))
    return matched.select("order_id", "cell", "district_name", "district_citycode")


@query
def join_track_trip(spark, d):
    points = v.points(spark, d)
    track = tracks.track_of_trips(points, tracks.trip_state(points))
    return track.select("order_id", "driver_id", _micros("ts"), "lng", "lat")


@query
def join_hot_split(spark, d):
    facts = v.table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    lookup = v.table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return joins.salted_join(facts, lookup, ["l_suppkey"], ["l_orderkey", "l_linenumber"], 7)


# ---- aggregations ----

@query
def agg_count_group(spark, d):
    return v.orders(spark, d).groupBy("city_name").agg(F.count(F.lit(1)).alias("n_orders"))


@query
def agg_count_global(spark, d):
    return v.renters(spark, d).agg(F.count(F.lit(1)).alias("n_users"))


@query
def agg_count_distinct(spark, d):
    return v.orders(spark, d).groupBy(text.region4(F.col("begin_address_code")).alias("region")).agg(
        F.count_distinct("vehicle_license").alias("n_vehicles")
    )


@query
def agg_active_users(spark, d):
    ts, during = F.col("ts"), periods.Periods.of(RENTER_DAY, "iso_year").during
    measures = {"DAU": during("day", ts), "WAU": during("week", ts), "MAU": during("month", ts)}
    return distinct_where(v.table(spark, d, "events"), [], "user_id", measures)


@query
def agg_sum(spark, d):
    typed = readers.scan_entity(_raw_orders(spark, d), "order", ["city_name", "charge_mileage", "pay_all"])
    return typed.groupBy("city_name").agg(
        F.sum("charge_mileage").alias("charge_mileage"), F.round(F.sum("pay_all"), 2).alias("pay_all")
    )


@query
def agg_conditional(spark, d):
    done = periods.effective(F.col("cancel"))
    return count_where(v.orders(spark, d), ["city_name"], {"effective": done, "cancelled": ~done})


@query
def agg_date_span(spark, d):
    spans = v.orders(spark, d).groupBy("city_name").agg(
        F.min("create_time").alias("first_time"), F.max("create_time").alias("last_time")
    )
    return spans.select(
        "city_name", _seconds("first_time"), _seconds("last_time"),
        (F.datediff("last_time", "first_time") + 1).alias("n_days"),
    )


@query
def agg_rate(spark, d):
    done = periods.effective(F.col("cancel"))
    counts = count_where(v.orders(spark, d), ["city_name"], {"eff": done, "total": F.lit(True)})
    return counts.select(
        "city_name", F.round(F.try_divide(F.col("eff") * 100, F.col("total")), 2).alias("rate")
    )


@query
def agg_collect_detail(spark, d):
    return hot.hot_detail(v.orders(spark, d))


@query
def agg_station_district(spark, d):
    placed = stations.stations_by_district(v.station_orders(spark, d), v.districts(spark, d), res=9)
    return stations.station_counts(placed)


@query
def agg_hour_to_day(spark, d):
    daily = tracks.daily_order_counts(tracks.hourly_order_counts(v.points(spark, d)))
    return daily.select(F.col("day").cast("string").alias("day"), "order_count")


@query
def agg_geo_centroid(spark, d):
    centers = spatial.centroid(v.orders(spark, d), ["city_name"], "open_lat", "open_lng")
    return centers.select(
        "city_name", F.round("center_lat", 6).alias("center_lat"), F.round("center_lng", 6).alias("center_lng")
    )


# ---- one per group ----

@query
def win_latest_per_cell(spark, d):
    cells = spatial.with_cell(v.orders(spark, d), "open_lat", "open_lng", hexgrid.HOT_RES)
    newest = spatial.latest_per_cell(cells, "create_time", "id", ["begin_address_code"])
    return newest.select("cell", "id", _seconds("create_time"), "begin_address_code")


@query
def win_station_per_cell(spark, d):
    return spatial.representatives(v.station_orders(spark, d), hexgrid.HOT_RES)


@query
def topk_recent(spark, d):
    return latest.newest_rows(v.hourly_gauges(spark, d), "snapshot_ms", 5)


@query
def last_position(spark, d):
    spot = tracks.last_position(v.points(spark, d))
    return spot.select("order_id", _micros("ts"), "lng", "lat")


@query
def first_position(spark, d):
    spot = tracks.first_position(v.points(spark, d))
    return spot.select("order_id", _micros("ts"), "lng", "lat")


@query
def active_orders(spark, d):
    return tracks.orders_of_city(tracks.active_orders(v.points(spark, d)), text.CITY_PREFIX)


# ---- scalar functions ----

@query
def fn_date(spark, d):
    ts = F.col("o_orderdate")
    return v.table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format(ts, "yyyy-MM-dd").alias("day"), F.date_format(ts, "yyyy-MM").alias("month"),
        F.date_format(ts, "yyyy").alias("year"), F.weekofyear(ts).alias("week"), F.quarter(ts).alias("quarter"),
        F.datediff(F.lit("2000-01-01"), ts).alias("days_to_2000"),
        F.date_sub(ts, 1).cast("string").alias("day_before"), times.month_suffix(ts).alias("suffix"),
    )


@query
def fn_epoch(spark, d):
    seconds = F.unix_timestamp("ts")
    return v.table(spark, d, "events").select(
        "event_id", times.epoch_seconds_text(seconds).alias("text"), times.epoch_hour(seconds).alias("hour"),
        times.epoch_millis_text(seconds * 1000 + 7).alias("from_millis"),
    )


@query
def fn_any_time(spark, d):
    millis = (F.unix_timestamp("ts") * 1000).cast("string")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    mixed = F.when(F.col("event_type") == "click", millis).when(F.col("event_type") == "view", iso).otherwise(
        F.lit("not a time")
    )
    return v.table(spark, d, "events").select("event_id", times.any_time_text(mixed).alias("text"))


@query
def fn_compact_time(spark, d):
    full = F.date_format("ts", times.SECOND_FORMAT)
    value = F.when(F.col("event_type") == "error", F.lit(" ")).when(
        F.col("event_type") == "view", F.substring(full, 1, 10)
    ).otherwise(full)
    return v.table(spark, d, "events").select(
        "event_id", times.compact_time(value).alias("compact"),
        times.compact_date(F.substring(value, 1, 10)).alias("compact_day"),
    )


@query
def fn_minus_15d(spark, d):
    minute = F.date_format("ts", times.COMPACT_MINUTE)
    return v.table(spark, d, "events").select("event_id", times.days_before(minute).alias("before"))


@query
def fn_string(spark, d):
    code = F.concat((F.col("c_nationkey") + 4600).cast("string"), F.lpad((F.col("c_custkey") % 20).cast("string"), 2, "0"))
    return v.table(spark, d, "customer").select(
        "c_custkey", text.region4(code).alias("region"), text.region6(text.region4(code)).alias("city_code"),
        F.nvl(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment"),
        F.round("c_acctbal", 0).cast("bigint").alias("balance"),
    )


@query
def fn_percent(spark, d):
    done = periods.effective(F.col("cancel")) & (F.col("driver_id") != "7")
    counts = count_where(v.orders(spark, d), ["driver_id"], {"part": done, "whole": F.lit(True)})
    part, whole = F.col("part"), F.col("whole")
    return counts.select(
        "driver_id", text.percent_rounded(part, whole).alias("rounded"),
        text.percent_decimal(part, whole).alias("two_digits"), text.percent_raw(part, whole).alias("raw"),
    )


@query
def fn_rowkey_salted(spark, d):
    return v.table(spark, d, "customer").select("c_name", keys.salted_key(F.col("c_name")).alias("rowkey"))


@query
def fn_rowkey_hash(spark, d):
    key = keys.hash_prefixed_key(F.col("c_name"), F.col("c_mktsegment"))
    return v.table(spark, d, "customer").select("c_custkey", F.hex(key).alias("rowkey"))


@query
def fn_rowkey_md5(spark, d):
    parts = (F.col("c_name"), F.col("c_mktsegment"))
    return v.table(spark, d, "customer").select(
        "c_custkey", *[keys.md5_prefixed_key("_", n, *parts).alias(f"md5_{n}") for n in (4, 16, 40)]
    )


@query
def fn_rowkey_plain(spark, d):
    return v.table(spark, d, "customer").select(
        "c_custkey", keys.plain_key(F.col("c_name"), F.col("c_mktsegment")).alias("rowkey"),
        keys.joined_key(F.col("c_name"), F.col("c_mktsegment")).alias("joined"),
    )


@query
def parse_gps(spark, d):
    parsed = lines.parse_gps(v.mixed_lines(spark, d))
    return parsed.select("driver_id", "order_id", "epoch", "lng", "lat", "is_end")


@query
def parse_order_line(spark, d):
    return lines.parse_order_lines(v.mixed_lines(spark, d))


@query
def parse_json_default(spark, d):
    return v.table(spark, d, "events").select(
        "event_id", text.json_field(F.col("props"), "k").alias("k"),
        text.json_field(F.col("props"), "type", "insert").alias("type"),
        text.json_field(F.col("props"), "absent").alias("absent"),
    )


@query
def record_to_map(spark, d):
    supplier = v.table(spark, d, "supplier")
    cells = F.map_entries(keys.record_map(supplier.columns))
    return supplier.select(
        "s_suppkey",
        F.array_join(F.transform(cells, lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("cells"),
        keys.record_json(["s_suppkey", "s_name"]).alias("json"),
    )


@query
def fn_order_key(spark, d):
    hashed = F.md5(F.col("c_name").cast("binary"))
    value = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).when(
        F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("075_"), hashed)
    ).otherwise(hashed)
    key = text.order_key(value)
    return v.table(spark, d, "customer").select(
        "c_custkey", key.alias("order_key"), text.bare_order_id(key).alias("bare_id")
    )


@query
def html_filter(spark, d):
    return v.marked_pages(spark, d).select("page_id", text.strip_unsafe_html(F.col("html")).alias("html"))


# ---- grid and polygons ----

def _cells(spark, d, res: int = hexgrid.HOT_RES) -> DataFrame:
    return spatial.with_cell(v.orders(spark, d), "open_lat", "open_lng", res)


@query
def cell_id(spark, d):
    fine = hexgrid.cell_id(F.col("open_lat"), F.col("open_lng"), hexgrid.STATION_RES)
    return _cells(spark, d).select("id", "cell", fine.alias("fine_cell"))


@query
def cell_center(spark, d):
    cells = _cells(spark, d).select("cell").distinct()
    return cells.select(
        "cell", hexgrid.cell_resolution(F.col("cell")).alias("res"),
        hexgrid.cell_lat_lng_text(F.col("cell"), hexgrid.HOT_RES).alias("center"),
    )


@query
def cell_boundary(spark, d):
    cells = _cells(spark, d).select("cell").distinct()
    corners = hexgrid.cell_boundary(F.col("cell"), hexgrid.HOT_RES)
    center = geometry.points_center(corners)
    return cells.select(
        "cell", hexgrid.points_text(corners).alias("boundary"),
        F.round(center["lng"], 4).alias("center_lng"), F.round(center["lat"], 4).alias("center_lat"),
    )


@query
def sql_cell_functions(spark, d):
    """The same cells through the SQL functions, at two resolutions."""
    sqlfunctions.register(spark)
    return v.orders(spark, d).selectExpr(
        "id", "location_to_cell(open_lat, open_lng, 7) as cell", "location_to_cell(open_lat, open_lng, 12) as fine_cell",
        "cell_to_coordinate(location_to_cell(open_lat, open_lng, 7)) as center",
    )


@query
def virtual_stations(spark, d):
    return stations.virtual_stations(v.station_orders(spark, d))


@query
def polygon_parse(spark, d):
    rings = geometry.parse_polygon(F.col("polygon"))
    parts = v.districts(spark, d).select("name", F.posexplode(rings).alias("part", "ring"))
    return parts.select("name", "part", F.posexplode("ring").alias("vertex", "p")).select(
        "name", "part", "vertex", F.col("p.lng").alias("lng"), F.col("p.lat").alias("lat")
    )


@query
def point_in_polygon(spark, d):
    matched = spatial.match_districts(v.station_orders(spark, d), v.districts(spark, d), salts=8)
    return matched.select("order_id", "district_name")


# ---- streams: run to the end of the input, then read the written tables ----

@query
def stream_source(spark, d):
    path = scratch_path(spark, "stream-source")
    jobs.wait(jobs.append_stream(
        v.records_stream(spark, d).select("topic", "value"), f"{path}/out", f"{path}/checkpoint", "source", None
    ))
    return spark.read.parquet(f"{path}/out").groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


def _ingest(spark, d, label: str) -> str:
    path = scratch_path(spark, label)
    jobs.wait(jobs.start_ingest(v.records_stream(spark, d), path, f"{path}/checkpoint", None))
    return path


@query
def stream_fanout(spark, d):
    path = _ingest(spark, d, "fanout")
    return readers.source_counts({n: sinks.read_changes(spark, f"{path}/{n}") for n in ("gps", "orders")})


@query
def stream_gps_ingest(spark, d):
    path = scratch_path(spark, "gps")
    rows = lines.gps_rows(v.gps_lines_of(v.table_stream(spark, d, "events")))
    jobs.wait(jobs.append_stream(rows, f"{path}/out", f"{path}/checkpoint", "gps", None))
    return spark.read.parquet(f"{path}/out")


@query
def stream_order_ingest(spark, d):
    path = scratch_path(spark, "orders")
    rows = lines.order_rows(v.order_lines_of(v.table_stream(spark, d, "lineitem")))
    jobs.wait(jobs.append_stream(rows, f"{path}/out", f"{path}/checkpoint", "orders", None))
    return spark.read.parquet(f"{path}/out")


def _live_points(spark, d) -> DataFrame:
    return lines.gps_events(v.gps_lines_of(v.table_stream(spark, d, "events")), "arrived_at")


def _run_state(spark, state: DataFrame, label: str, order: list[str]) -> DataFrame:
    path = scratch_path(spark, label)
    jobs.wait(jobs.start_state(state, f"{path}/out", f"{path}/checkpoint", label, interval=None))
    return sinks.read_current(spark, f"{path}/out", order)


@query
def stream_active_orders(spark, d):
    activity = _run_state(spark, tracks.order_activity(_live_points(spark, d)), "active", ["order_id"])
    return tracks.active_of(activity)


@query
def stream_trip_state(spark, d):
    trips = _run_state(spark, tracks.trip_state(_live_points(spark, d)), "trips", ["order_id"])
    return trips.select(
        "city_code", "order_id", _seconds("start_time"), _seconds("end_time"), "get_on_lng", "get_on_lat",
        "get_off_lng", "get_off_lat",
    )


@query
def stream_hourly_orders(spark, d):
    first = _run_state(spark, jobs.first_seen(_live_points(spark, d)), "hourly", ["order_id"])
    return first.groupBy(
        F.date_format(F.date_trunc("hour", "first_ts"), times.SECOND_FORMAT).alias("hour")
    ).agg(F.count(F.lit(1)).alias("order_count"))


@query
def stream_cdc_apply(spark, d):
    path = scratch_path(spark, "cdc")
    messages = v.order_changes_of(v.table_stream(spark, d, "orders"))
    jobs.wait(jobs.start_cdc(messages, f"{path}/out", f"{path}/checkpoint", None))
    current = sinks.read_current(spark, f"{path}/out/{cdc.ORDER_TABLE}", ["id"], ["ts", "offset"])
    return current.select("rowkey", "id", "op", *v.FILLED_ORDER_CELLS)


@query
def stream_cdc_compact(spark, d):
    """Compacts, then starts a stream anew on other changes: no key of the first run is lost."""
    path, changes = scratch_path(spark, "cdc-compact"), {}
    for part, op in (("first", "o_orderkey % 2 = 0"), ("second", "o_orderkey % 2 = 1")):
        changes[part] = f"{path}/in-{part}"
        v.table(spark, d, "orders").where(op).write.parquet(changes[part])
    for part, folder in changes.items():
        messages = v.order_changes_of(readers.stream_files(spark, folder, v.table(spark, d, "orders").schema))
        jobs.wait(jobs.start_cdc(messages, f"{path}/out", f"{path}/checkpoint-{part}", None))
        sinks.compact(spark, f"{path}/out/{cdc.ORDER_TABLE}", ["id"], ["ts", "offset"])
    current = sinks.read_current(spark, f"{path}/out/{cdc.ORDER_TABLE}", ["id"], ["ts", "offset"])
    return current.select("rowkey", "id", "op", *v.FILLED_ORDER_CELLS)


def _arriving(spark, d, path: str, parts: int = 4) -> DataFrame:
    """The events as a stream that arrives in order of time: one file per time range, one file per batch."""
    events = v.table(spark, d, "events")
    cuts = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [n / parts for n in range(1, parts)])).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges, edges[1:]):  # written one after the other: a file source goes by time of writing
        micros, ranged = F.unix_micros(F.col("ts").cast("timestamp")), events
        ranged = ranged if low is None else ranged.where(micros > low)
        ranged = ranged if high is None else ranged.where(micros <= high)
        ranged.coalesce(1).sortWithinPartitions("ts", "event_id").write.mode("append").parquet(path)
    return readers.stream_files(spark, f"{path}/*.parquet", events.schema, max_files=1)


@query
def stream_hourly_first(spark, d):
    """Orders per hour of the point processed first, for points that arrive in order of time."""
    path = scratch_path(spark, "hourly-first")
    live = lines.gps_events(v.gps_lines_of(_arriving(spark, d, f"{path}/in")), "arrived_at")
    jobs.wait(jobs.start_state(jobs.hourly_first_processed(live), f"{path}/out", f"{path}/checkpoint", "hourly_first", mode="complete", interval=None))
    newest = sinks.read_current(spark, f"{path}/out", ["hour"])
    return newest.select(F.date_format("hour", times.SECOND_FORMAT).alias("hour"), "order_count")


@query
def stream_closed_trips(spark, d):
    """Trips that were over an hour before the last event, for points that arrive in order of time."""
    path = scratch_path(spark, "closed-trips")
    live = lines.gps_events(v.gps_lines_of(_arriving(spark, d, f"{path}/in")), "arrived_at")
    jobs.wait(jobs.start_trip_closing(live, f"{path}/out", f"{path}/checkpoint", interval=None))
    trips = spark.read.parquet(f"{path}/out")
    return trips.select("order_id", _seconds("start_time"), _seconds("end_time"), "get_on_lng", "get_on_lat", "get_off_lng", "get_off_lat", "has_end", "n_points")


@query
def stream_offsets(spark, d):
    """The events' lines in a log of four partitions, followed by offsets: records and offsets of each partition."""
    path = scratch_path(spark, "offsets")
    records = v.gps_lines_of(v.table(spark, d, "events")).select("value", "offset", (F.col("offset") % 4).alias("part")).withColumnRenamed("offset", "event_id")
    cut = records.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0] or 0
    for half in (F.col("event_id") <= cut, F.col("event_id") > cut):
        topics.append_records(records.where(half), f"{path}/log", "part", ["event_id"])
    stream = topics.stream_records(spark, f"{path}/log", max_offsets=max(1, records.count() // 3)).drop("part")
    started = jobs.append_stream(stream, f"{path}/out", f"{path}/checkpoint", "offsets", "0 seconds")
    try:
        started.processAllAvailable()
    finally:
        started.stop()
    read = spark.read.parquet(f"{path}/out")
    in_order = F.max(F.struct("offset", "event_id"))["event_id"].alias("last_event")
    return read.groupBy("partition").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("offset").alias("n_offsets"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.sum(F.length("value")).alias("n_chars"), in_order,
    )


@query
def stream_trigger(spark, d):
    """A query under a processing-time trigger: it goes on by itself until all lines are there, then it is stopped."""
    path = scratch_path(spark, "trigger")
    rows = lines.gps_rows(v.gps_lines_of(v.table_stream(spark, d, "events")))
    started = jobs.append_stream(rows, f"{path}/out", f"{path}/checkpoint", "trigger", "1 second")
    try:
        started.processAllAvailable()
    finally:
        started.stop()
    return spark.read.parquet(f"{path}/out").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("orderid").alias("n_orders"))


@query
def stream_query_events(spark, d):
    """Start and end of a query, as its recorder wrote them."""
    path = scratch_path(spark, "query-events")
    recorder = metrics.ProgressRecorder(spark, f"{path}/events")
    spark.streams.addListener(recorder)
    try:
        started = jobs.append_stream(v.table_stream(spark, d, "events"), f"{path}/out", f"{path}/checkpoint", "events", None)
        jobs.wait(started)
        recorder.wait_for(started)
    finally:
        spark.streams.removeListener(recorder)
    own = recorder.events().where((F.col("query_id") == str(started.id)) & F.col("event").isin("started", "terminated"))
    written = spark.read.parquet(f"{path}/out").agg(F.count(F.lit(1)).alias("n_rows"))
    return own.groupBy("event").agg(F.count(F.lit(1)).alias("n_events")).join(written)


@query
def stream_routed_ingest(spark, d):
    """One query that routes all lines; nothing is lost: rows, markers and reasons add up to the lines."""
    path = scratch_path(spark, "routed")
    jobs.wait(jobs.start_routed_ingest(v.records_stream(spark, d), f"{path}/out", f"{path}/checkpoint", None))
    return readers.source_counts({n: sinks.read_changes(spark, f"{path}/out/{n}") for n in ("gps", "orders", "quarantine")})


@query
def stream_progress(spark, d):
    path = scratch_path(spark, "progress")
    recorder = metrics.ProgressRecorder(spark, f"{path}/events")
    spark.streams.addListener(recorder)
    try:
        started = jobs.append_stream(
            v.gps_lines_of(v.table_stream(spark, d, "events")).select("value"),
            f"{path}/out", f"{path}/checkpoint", "progress", None,
        )
        jobs.wait(started)
        recorder.wait_for(started)
    finally:
        spark.streams.removeListener(recorder)
    own = recorder.events().where((F.col("event") == "progress") & (F.col("query_id") == str(started.id)))
    flagged = metrics.progress_flags(metrics.flatten_progress(own))
    return flagged.groupBy("query_name").agg(
        F.sum("num_input_rows").alias("n_rows"), F.sum("source_rows").alias("n_source_rows"),
        F.count_if(F.col("num_input_rows") > 0).alias("n_batches"),
    )


@query
def trip_state(spark, d):
    trips = tracks.trip_state(v.points(spark, d))
    return trips.select(
        "city_code", "order_id", _seconds("start_time"), _seconds("end_time"), "get_on_lng", "get_on_lat",
        "get_off_lng", "get_off_lat",
    )


@query
def hourly_order_count(spark, d):
    hourly = tracks.hourly_order_counts(v.points(spark, d))
    return hourly.select(_seconds("hour"), "order_count")


@query
def position_queue(spark, d):
    queue = tracks.position_queue(v.points(spark, d))
    return queue.select("order_id", _micros("ts"), "entry", "queue_index")


def _queue(spark, d, label: str) -> str:
    path = scratch_path(spark, label)
    jobs.wait(queue.start_position_queue(_live_points(spark, d), f"{path}/out", f"{path}/checkpoint", None))
    return f"{path}/out"


@query
def stream_position_queue(spark, d):
    placed = queue.read_queue(spark, _queue(spark, d, "queue"))
    return placed.select("order_id", _micros("ts"), "entry", "queue_index")


@query
def stream_position_heads(spark, d):
    """The three newest entries of every order, from its newest segments."""
    heads = queue.read_queue(spark, _queue(spark, d, "heads"), newest=3)
    return heads.select("order_id", _micros("ts"), "entry", "queue_index")


# ---- change data ----

@query
def cdc_apply(spark, d):
    return cdc.apply(v.changes(spark, d), cdc.ORDER_TABLE).select(
        "rowkey", "id", "operator_type", *v.FILLED_ORDER_CELLS, "driver_id"
    )


@query
def cdc_apply_renter(spark, d):
    return cdc.apply(v.changes(spark, d), cdc.RENTER_TABLE)


@query
def cdc_apply_driver(spark, d):
    return cdc.apply(v.changes(spark, d), cdc.DRIVER_TABLE).select(
        "rowkey", "id", "operator_type", "register_city", "driver_name", "driver_type", "mobile"
    )


@query
def cdc_apply_alliance(spark, d):
    applied = cdc.typed_alliance_roles(cdc.apply(v.changes(spark, d), cdc.ALLIANCE_TABLE))
    return applied.select("id", "alliance_name", F.explode("alliance_role").alias("role"))


@query
def cdc_route(spark, d):
    return cdc.parse(v.changes(spark, d)).groupBy("entity", "source_table", "op").agg(
        F.count(F.lit(1)).alias("n_changes")
    )


@query
def cdc_delete_modes(spark, d):
    rows = cdc.entity_rows(cdc.parse(v.changes(spark, d)), cdc.ORDER_TABLE)
    return cdc.images_by_mode(rows).select("mode", "id", "op", "pay_all")


@query
def stream_cdc_deletes(spark, d):
    """The order table under each delete mode, kept by streams of their own."""
    path, frames = scratch_path(spark, "cdc-deletes"), []
    for mode in cdc.DELETE_MODES:
        messages = v.order_changes_of(v.table_stream(spark, d, "orders"))
        jobs.wait(jobs.start_cdc(messages, f"{path}/{mode}", f"{path}/checkpoint-{mode}", None, deletes=mode))
        applied = jobs.read_applied(spark, f"{path}/{mode}", cdc.ORDER_TABLE, mode)
        frames.append(applied.select(F.lit(mode).alias("mode"), "id", "op", "pay_all"))
    return reduce(DataFrame.unionByName, frames)


@query
def cdc_quarantine(spark, d):
    marked = cdc.with_reason(v.changes(spark, d).unionByName(v.broken_changes(spark, d)))
    good, bad = cdc.split(marked)
    return bad.select("reason").unionByName(good.select(F.lit("none").alias("reason"))).groupBy("reason").agg(F.count(F.lit(1)).alias("n_messages"))


# ---- reports ----

def _money(df: DataFrame, *names: str) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; a report shows cents."""
    return df.withColumns({n: F.round(n, 2) for n in names})


REPORTS: dict[str, Query] = {
    "completion_city": lambda s, d: reports.completion_by_city(v.orders(s, d), DAY),
    "completion_driver": lambda s, d: reports.completion_by_driver(v.orders(s, d), DAY),
    "driver_registrations": lambda s, d: reports.driver_registrations(v.drivers(s, d), DRIVER_DAY),
    "region_orders": lambda s, d: reports.region_orders(v.orders(s, d), DAY),
    "platform_totals": lambda s, d: reports.platform_totals(v.orders(s, d), DAY),
    "income": lambda s, d: _money(reports.income(v.orders(s, d), v.renters(s, d)), "pay_all"),
    "hot_cells": lambda s, d: hot.hot_cells(v.orders(s, d), DAY),
    "hot_points": lambda s, d: hot.hot_points(v.orders(s, d), "2000-01-01"),
    "region_users": lambda s, d: reports.region_users(v.renters(s, d), RENTER_DAY),
    "new_users": lambda s, d: reports.new_users(v.renters(s, d), "2024-01-01"),
    "active_users": lambda s, d: reports.active_users(v.renters(s, d), RENTER_DAY),
    "retention": lambda s, d: reports.retention(v.renters(s, d), PAIRS),
}

for _name, _build in REPORTS.items():
    QUERIES[f"report_{_name}"] = _build
    QUERIES[f"serve_{_name}"] = lambda s, d, n=_name, b=_build: serving.serve(b(s, d), n)


@query
def batch_run_all(spark, d):
    """The whole batch, written as tables: name and row count of every report."""
    sources = {
        "order": v.orders(spark, d), "renter": v.renters(spark, d), "driver": v.drivers(spark, d),
        "station_order": v.station_orders(spark, d), "district": v.districts(spark, d),
    }
    path = scratch_path(spark, "batch")
    errors = batch.write_all(batch.run_all(sources, DAY), path)
    failed = {name: error for name, error in errors.items() if error}
    if failed:
        raise RuntimeError(failed)
    return readers.source_counts({name: sinks.read_report(spark, f"{path}/{name}") for name in errors})


@query
def batch_upsert(spark, d):
    """The whole batch put into its tables by key, twice: rows of every table, whose keys are there once."""
    sources = {
        "order": v.orders(spark, d), "renter": v.renters(spark, d), "driver": v.drivers(spark, d),
        "station_order": v.station_orders(spark, d), "district": v.districts(spark, d),
    }
    path, outcomes = scratch_path(spark, "batch-upsert"), batch.run_all(sources, DAY)
    for _ in range(2):
        errors = batch.upsert_all(outcomes, path, DAY)
        failed = {name: error for name, error in errors.items() if error}
        if failed:
            raise RuntimeError(failed)
    return readers.source_counts({name: sinks.read_report(spark, f"{path}/{name}") for name in errors})


def _partials(spark, facts: DataFrame, name: str, as_of: str) -> str:
    """Daily partial results of all days, the day of the report put in by an update of its own."""
    path = scratch_path(spark, f"partials-{name}")
    first, last = facts.agg(F.to_date(F.min("create_time")), F.to_date(F.max("create_time"))).first()
    day = dt.date.fromisoformat(as_of)
    for start, end in ((first, day - dt.timedelta(days=1)), (day, day), (day + dt.timedelta(days=1), last)):
        partials.update_days(facts, path, name, start, end)
    return path


@query
def report_completion_city_incremental(spark, d):
    return partials.completion_by_city(spark, _partials(spark, v.orders(spark, d), "completion_city", DAY), DAY)


@query
def report_completion_driver_incremental(spark, d):
    return partials.completion_by_driver(spark, _partials(spark, v.orders(spark, d), "completion_driver", DAY), DAY)


@query
def report_driver_registrations_incremental(spark, d):
    return partials.driver_registrations(spark, _partials(spark, v.drivers(spark, d), "driver_registrations", DRIVER_DAY), DRIVER_DAY)


@query
def report_region_orders_incremental(spark, d):
    return partials.region_orders(spark, _partials(spark, v.orders(spark, d), "region_orders", DAY), DAY)


@query
def report_platform_totals_incremental(spark, d):
    totals = partials.platform_totals(spark, _partials(spark, v.orders(spark, d), "platform", DAY), DAY)
    return _money(totals, "charge_mileage").drop("pay_all")


@query
def rolling_active_users(spark, d):
    """Logons are purchases; 60 days from one pass."""
    logons = v.table(spark, d, "events").where("event_type = 'purchase'")
    return rolling.rolling_active_users(logons, "user_id", "ts", RENTER_DAY)


@query
def rolling_retention(spark, d):
    """Users who signed up on a day, and those of them who bought 1, 7 and 30 days later."""
    events = v.table(spark, d, "events")
    places = rolling.user_places(events, "user_id")
    created = rolling.daily_bitmaps(events.where("event_type = 'signup'"), places, "user_id", "ts")
    logged = rolling.daily_bitmaps(events.where("event_type = 'purchase'"), places, "user_id", "ts")
    return rolling.cohort_retention(created, logged, "2023-12-02", RENTER_DAY)


@query
def report_upsert(spark, d):
    """Two days' orders into one table keyed by driver: keys of the first day stay, common ones are of the second."""
    path, orders = scratch_path(spark, "upsert"), v.orders(spark, d)
    for day in ("1998-07-14", DAY):
        of_day = orders.where(F.to_date("create_time") == F.lit(day).cast("date"))
        counted = of_day.groupBy("driver_id").agg(F.count(F.lit(1)).alias("n_orders")).withColumn("day", F.lit(day))
        sinks.upsert_report(counted, path, ["driver_id"], ["day"])
    return sinks.read_report(spark, path)


@query
def write_stations(spark, d):
    path = scratch_path(spark, "stations")
    sinks.write_report(report_virtual_stations(spark, d), path, "order_id")
    return sinks.read_report(spark, path)


@query
def report_hot_change(spark, d):
    return hot.hot_change(v.orders(spark, d), DAY)


@query
def report_completion_city_iso_week(spark, d):
    return reports.completion_by_city(v.orders(spark, d), DAY, "iso_year")


@query
def report_virtual_stations(spark, d):
    return stations.stations_by_district(v.station_orders(spark, d), v.districts(spark, d))


@query
def report_station_counts(spark, d):
    return stations.station_counts(report_virtual_stations(spark, d))


@query
def stations_query(spark, d):
    return serving.stations_query(report_virtual_stations(spark, d), "4603")


@query
def stations_count(spark, d):
    return serving.stations_count(report_virtual_stations(spark, d), "4603")


@query
def day_overview(spark, d):
    overview = serving.day_overview(v.points(spark, d), lines.parse_order_lines(v.order_lines(spark, d)))
    return overview.withColumn("day", F.col("day").cast("string"))


# ---- metrics ----

@query
def progress_flags(spark, d):
    flagged = metrics.progress_flags(v.hourly_progress(spark, d))
    return flagged.drop("duration_ms")


@query
def task_metrics(spark, d):
    return metrics.stage_metrics(metrics.task_metrics(v.event_log_lines(spark, d)))


@query
def metrics_ratios(spark, d):
    return metrics.metrics_ratios(v.hourly_gauges(spark, d))
