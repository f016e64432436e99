"""Ride-hailing views over the general test tables.

A ride is a line item, a city is a nation, a rider is an event user, a driver
is a customer; a trip is one user on one day. All are lazy, so a report only
reads the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.pinning import pin
from wayfare.sources.readers import stream_files
from wayfare.sources.schema import CDC_ORDER, ENTITIES, ORDER_LINE
from wayfare.streaming.jobs import GPS_TOPIC, ORDER_TOPIC
from wayfare.streaming.lines import HEADER_TOKEN

ORDERS_AS_OF = "1998-07-15"
DRIVERS_AS_OF = "1995-02-15"
RENTERS_AS_OF = "2024-01-30"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return stream_files(spark, f"{folder}/{name}.parquet", table(spark, folder, name).schema)


def _text(name: str) -> Column:
    return F.col(name).cast("string")


RIDE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, to_date(l_shipdate))"
RIDE_LNG = "110.1D + cast((l_partkey * 7919) % 10000 as double) / 1e4D * 0.6D"
RIDE_LAT = "19.6D + cast((l_orderkey * 104729) % 10000 as double) / 1e4D * 0.5D"


def orders(spark: SparkSession, folder: str) -> DataFrame:
    rides = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return rides.selectExpr(
        f"{RIDE_ID} as id",
        "l_shipdate as create_time",
        "l_extendedprice as pay_all",
        "l_quantity as charge_mileage",
        f"{RIDE_LNG} as open_lng",
        f"{RIDE_LAT} as open_lat",
        "concat(s_nationkey + 4600, lpad(l_partkey % 20, 2, '0')) as begin_address_code",
        "n_name as city_name",
        "concat('V', l_partkey) as vehicle_license",
        "cast(l_suppkey as string) as driver_id",
        "s_name as driver_name",
        "if(l_returnflag = 'R', 1, 0) as cancel",
    )


def station_orders(spark: SparkSession, folder: str) -> DataFrame:
    return orders(spark, folder).select(
        F.col("id").alias("order_id"),
        F.substring("begin_address_code", 1, 4).alias("city_id"),
        F.col("open_lng").alias("starting_lng"),
        F.col("open_lat").alias("starting_lat"),
    )


def renters(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "events").groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("create_time"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_logon_time"),
    )
    city = F.concat((F.col("user_id") % 25 + 4600).cast("string"), F.lit("00"))
    return users.select(
        _text("user_id").alias("id"), "create_time", "last_logon_time", city.alias("last_login_city")
    )


def drivers(spark: SparkSession, folder: str) -> DataFrame:
    first = table(spark, folder, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("create_time"))
    joined = table(spark, folder, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select(
        _text("c_custkey").alias("id"),
        "create_time",
        F.concat((F.col("c_nationkey") + 4600).cast("string"), F.lit("00")).alias("register_city"),
        F.col("c_name").alias("driver_name"),
    )


def raw_like(df: DataFrame, entity: str) -> DataFrame:
    """A frame with all columns of an entity; those it lacks are NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in ENTITIES[entity].items()])


def marked_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with unsafe and harmless markup around their addresses, by page number."""
    url, n = F.col("url"), F.col("page_id") % 8
    extra = (
        F.when(n == 0, F.concat(F.lit('<a onclick="go(1)" href="'), url, F.lit('">x</a>')))
        .when(n == 1, F.concat(F.lit("<IFRAME src='"), url, F.lit("'>\nframe</ iframe >tail")))
        .when(n == 2, F.concat(F.lit('<link rel=x href="'), url, F.lit('"><linked>kept</linked>')))
        .when(n == 3, F.concat(F.lit('<meta content="on=1" name=contents> one=2 '), url))
        .when(n == 4, F.concat(F.lit('<a class=b HREF = " javascript:run()">'), url, F.lit("</a><a href=javascript:x()>y</a>")))
        .when(n == 5, F.concat(F.lit("<object data='"), url, F.lit("'><embed src=a></object><img onerror = bad() src=b>")))
        .when(n == 6, F.concat(F.lit("<frameset><frame></frameset><base target=_top>"), url))
        .otherwise(url)
    )
    return table(spark, folder, "pages").select("page_id", F.concat("html", extra).alias("html"))


# ---- districts: one diamond per nation, with a square hole for even keys ----

def _degrees(ticks: str) -> str:
    return f"concat(cast(({ticks}) div 10000 as string), '.', lpad(cast(({ticks}) % 10000 as string), 4, '0'))"


def _ring(corners: list[tuple[int, int]]) -> str:
    cx, cy = "1101600 + (n_nationkey % 5) * 1200", "196500 + (n_nationkey div 5) * 1000"
    vertices = [f"concat({_degrees(f'{cx} + {dx}')}, ',', {_degrees(f'{cy} + {dy}')})" for dx, dy in corners]
    return f"concat_ws(';', {', '.join(vertices)})"


OUTER = [(-800, 0), (0, 650), (800, 0), (0, -650)]
HOLE = [(-150, -150), (150, -150), (150, 150), (-150, 150)]


def districts(spark: SparkSession, folder: str) -> DataFrame:
    outer, hole = _ring(OUTER), _ring(HOLE)
    polygon = F.expr(f"case when n_nationkey % 2 = 0 then concat_ws('|', {outer}, {hole}) else {outer} end")
    return pin(table(spark, folder, "nation"), polygon=polygon).select(
        (F.col("n_nationkey") + 4600).cast("string").alias("citycode"),
        F.col("n_name").alias("name"),
        "polygon",
        F.col("n_regionkey").alias("region_key"),
    )


def district_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One district tree per region (a handful of nations each)."""
    node = F.struct("name", "citycode", F.lit("district").alias("level"), F.col("polygon").alias("polyline"))
    trees = districts(spark, folder).groupBy("region_key").agg(F.collect_list(node).alias("children"))
    city = F.struct(
        F.concat(F.lit("REGION_"), _text("region_key")).alias("name"),
        F.lit("city").alias("level"),
        F.col("children").alias("districts"),
    )
    return trees.select(F.to_json(F.struct(F.array(city).alias("districts"))).alias("value"))


def geojson_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One FeatureCollection per nation."""
    rings = F.transform(
        F.split("polygon", r"\|"),
        lambda part: F.array(F.transform(F.split(part, ";"), lambda v: F.split(v, ",").cast("array<double>"))),
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("name").alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), rings.alias("coordinates")).alias("geometry"),
    )
    collection = F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
    return districts(spark, folder).select(F.to_json(collection).alias("value"))


# ---- positions and message lines ----

def points_of(events: DataFrame) -> DataFrame:
    trip = F.concat_ws("_", _text("user_id"), F.to_date("ts").cast("string"))
    return events.select(
        _text("user_id").alias("driver_id"),
        trip.alias("order_id"),
        "ts",
        F.unix_timestamp("ts").alias("epoch"),
        (F.lit(104.0) + F.col("value") / F.lit(1000.0)).alias("lng"),
        (F.lit(30.6) + (F.col("event_id") % 1000).cast("double") / F.lit(10000.0)).alias("lat"),
        (F.col("event_type") == "purchase").alias("is_end"),
        "event_id",
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    return points_of(table(spark, folder, "events"))


def gps_lines_of(events: DataFrame) -> DataFrame:
    line = F.when(F.col("is_end"), F.concat(F.lit("end,"), F.col("order_id"))).otherwise(
        F.concat_ws(",", "driver_id", "order_id", _text("epoch"), _text("lng"), _text("lat"))
    )
    return pin(points_of(events), value=line).select(
        "value", F.lit(GPS_TOPIC).alias("topic"),
        F.col("ts").cast("timestamp").alias("arrived_at"), F.col("event_id").alias("offset"),
    )


def order_lines_of(lineitem: DataFrame) -> DataFrame:
    day = F.to_date("l_shipdate").cast("string")
    units = F.col("l_quantity").cast("int")
    cells = {
        "order_id": F.expr(RIDE_ID), "product_id": _text("l_partkey"), "city_id": F.lit("125"),
        "district": F.lit("0898"), "county": _text("l_linenumber"), "type": F.col("l_returnflag"),
        "combo_type": F.lit("0"), "traffic_type": F.lit("0"),
        "passenger_count": (units % 4 + 1).cast("string"), "driver_product_id": _text("l_suppkey"),
        "start_dest_distance": (units * 100).cast("string"),
        "arrive_time": F.concat(day, F.lit(" 08:30:00")), "departure_time": F.concat(day, F.lit(" 08:00:00")),
        "pre_total_fee": F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        "normal_time": (units + 5).cast("string"), "bubble_trace_id": F.md5(F.expr(RIDE_ID).cast("binary")),
        "product_1level": F.col("l_linestatus"), "dest_lng": F.lit("110.33"), "dest_lat": F.lit("20.02"),
        "starting_lng": F.expr(RIDE_LNG).cast("string"), "starting_lat": F.expr(RIDE_LAT).cast("string"),
        "year": F.date_format("l_shipdate", "yyyy"), "month": F.date_format("l_shipdate", "MM"),
        "day": F.date_format("l_shipdate", "dd"),
    }
    # stored lines are plain text: the text must not be built again inside filters
    return pin(lineitem, value=F.concat_ws("\t", *[cells[c] for c in ORDER_LINE])).select(
        "value",
        F.lit(ORDER_TOPIC).alias("topic"),
        F.col("l_shipdate").cast("timestamp").alias("arrived_at"),
        F.col("l_orderkey").alias("offset"),
    )


def gps_lines(spark: SparkSession, folder: str) -> DataFrame:
    return gps_lines_of(table(spark, folder, "events"))


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines_of(table(spark, folder, "lineitem"))


def mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Good lines of both kinds among headers, short lines, bad numbers and noise."""
    nation, supplier = table(spark, folder, "nation"), table(spark, folder, "supplier")
    customer, order_table = table(spark, folder, "customer"), table(spark, folder, "orders")
    header = F.concat_ws("\t", *[F.lit(f"{HEADER_TOKEN}.{c}") for c in ORDER_LINE[:-1]], "n_name")
    parts = [
        gps_lines(spark, folder).select("value"),
        order_lines(spark, folder).select("value"),
        nation.select(header.alias("value")),
        supplier.select(F.concat_ws("\t", _text("s_suppkey"), "s_name").alias("value")),
        customer.select(F.col("c_name").alias("value")),
        order_table.select(
            F.concat_ws(",", _text("o_custkey"), _text("o_orderkey"), "o_orderpriority", F.lit("104.1"), F.lit("30.1"))
            .alias("value")
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def records_stream(spark: SparkSession, folder: str) -> DataFrame:
    gps = gps_lines_of(table_stream(spark, folder, "events"))
    return gps.unionByName(order_lines_of(table_stream(spark, folder, "lineitem")))


# ---- change envelopes ----

def _envelope(table_name: Column, op: Column, ts: Column, data: Column) -> Column:
    return F.to_json(F.struct(table_name.alias("table"), op.alias("type"), ts.alias("ts"), data.alias("data")))


def order_changes_of(order_table: DataFrame) -> DataFrame:
    """Changes keyed by customer; open orders carry no type, filled ones delete."""
    op = F.when(F.col("o_orderstatus") == "F", F.lit("delete")).when(
        F.col("o_orderstatus") == "P", F.lit("update")
    )
    data = F.struct(
        _text("o_custkey").alias("id_"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("pay_all"),
        F.lit(None).cast("string").alias("city_name"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_orderpriority").alias("order_type"),
    )
    name = F.concat(F.lit("order_info_"), F.date_format("o_orderdate", "yyyy"))
    envelope = _envelope(name, op, F.unix_timestamp("o_orderdate"), data)
    return pin(order_table, value=envelope).select("value", F.col("o_orderkey").alias("offset"))


def changes(spark: SparkSession, folder: str) -> DataFrame:
    events, customer = table(spark, folder, "events"), table(spark, folder, "customer")
    supplier, part = table(spark, folder, "supplier"), table(spark, folder, "part")
    zero = F.lit(0).cast("bigint")
    renter = pin(
        events, value=_envelope(
            F.lit("renter_info"), F.lit("update"), F.unix_timestamp("ts"),
            F.struct(
                _text("user_id").alias("id_"),
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_logon_time"),
                F.col("event_type").alias("city_name"),
            ),
        ),
    ).select("value", F.col("event_id").alias("offset"))
    driver = pin(
        customer, value=_envelope(
            F.lit("driver_info"), F.lit("insert"), zero,
            F.struct(
                _text("c_custkey").alias("id_"), F.col("c_name").alias("driver_name"),
                F.concat((F.col("c_nationkey") + 4600).cast("string"), F.lit("00")).alias("register_city"),
                F.col("c_mktsegment").alias("driver_type"),
            ),
        ),
    ).select("value", F.col("c_custkey").alias("offset"))
    alliance = pin(
        supplier, value=_envelope(
            F.lit("opt_alliance_business"), F.lit("insert"), zero,
            F.struct(
                _text("s_suppkey").alias("id_"), F.col("s_name").alias("alliance_name"),
                F.concat_ws(",", _text("s_nationkey"), F.lit("owner")).alias("alliance_role"),
            ),
        ),
    ).select("value", F.col("s_suppkey").alias("offset"))
    unknown = pin(
        part, value=_envelope(F.lit("sys_log"), F.lit("insert"), zero, F.struct(_text("p_partkey").alias("id_"))),
    ).select("value", F.col("p_partkey").alias("offset"))
    return (
        order_changes_of(table(spark, folder, "orders"))
        .unionByName(renter).unionByName(driver).unionByName(alliance).unionByName(unknown)
    )


def broken_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that cannot be applied: plain text, no table, no data, no id, an empty id."""
    data = F.struct(F.col("n_name").alias("driver_name"))
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    texts = [
        nation.select(F.col("n_name").alias("value"), _text("n_nationkey").alias("offset")),
        nation.select(F.to_json(F.struct(F.lit("insert").alias("type"), data.alias("data"))), _text("n_nationkey")),
        nation.select(F.to_json(F.struct(F.lit("driver_info").alias("table"), data.alias("data"))), _text("n_nationkey")),
        region.select(F.to_json(F.struct(F.lit("renter_info").alias("table"), F.struct(F.lit("").alias("id_")).alias("data"))), _text("r_regionkey")),
        region.select(F.to_json(F.struct(F.lit("renter_info").alias("table"))), _text("r_regionkey")),
        region.select(F.lit(None).cast("string"), _text("r_regionkey")),
    ]
    out = texts[0]
    for t in texts[1:]:
        out = out.union(t)
    return out.withColumn("offset", F.col("offset").cast("bigint"))


FILLED_ORDER_CELLS = [c for c in CDC_ORDER if c in ("create_time", "pay_all", "city_name", "state", "order_type")]


# ---- metrics ----

def hourly_gauges(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per hour, read as dashboard gauges."""
    hour = F.date_trunc("hour", "ts")
    kinds = {
        "failed_stages": "error", "running_stages": "click", "waiting_stages": "view",
        "running_batches": "signup", "waiting_batches": "error", "completed_batches": "purchase",
        "mem_used_mb": "click", "remaining_mem_mb": "purchase", "max_mem_mb": "view",
    }
    gauges = table(spark, folder, "events").groupBy(hour.alias("hour")).agg(
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in kinds.items()]
    )
    return gauges.select((F.unix_timestamp("hour") * 1000).alias("snapshot_ms"), *kinds)


def hourly_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One batch per hour: its durations come from the values of the hour's events."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    hour = F.date_trunc("hour", "ts")
    sums = table(spark, folder, "events").groupBy(hour.alias("hour")).agg(
        F.sum(cents).alias("cents"),
        F.sum(F.when(F.col("event_type") == "error", cents).otherwise(0)).alias("gc_ms"),
        F.count(F.lit(1)).alias("num_input_rows"),
    )
    phases = F.create_map(
        F.lit("addBatch"), F.shiftright("cents", 1), F.lit("walCommit"), F.col("num_input_rows"),
        F.lit("queryPlanning"), F.lit(7).cast("bigint"),
    )
    return sums.select(
        F.unix_timestamp("hour").alias("batch_id"), "num_input_rows", phases.alias("duration_ms"), "gc_ms"
    )


def event_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Event-log text: a finished task per line item, and a start event beside it."""
    li = table(spark, folder, "lineitem")
    units = F.col("l_quantity").cast("bigint")
    metrics = F.struct(
        (units * 10).alias("Executor Run Time"), units.alias("JVM GC Time"),
        F.lit(0).cast("bigint").alias("Memory Bytes Spilled"), (units * 3).alias("Disk Bytes Spilled"),
        F.struct((units * 5).alias("Total Records Read")).alias("Shuffle Read Metrics"),
        F.struct((units * 7).alias("Shuffle Bytes Written")).alias("Shuffle Write Metrics"),
        F.struct((units * 11).alias("Bytes Read"), F.col("l_partkey").alias("Records Read")).alias("Input Metrics"),
    )
    info = F.struct(
        F.col("l_orderkey").alias("Task ID"), (F.col("l_returnflag") == "R").alias("Failed"),
        F.lit(1000).cast("bigint").alias("Launch Time"), (units * 12 + 1000).alias("Finish Time"),
    )
    end = F.struct(
        F.lit("SparkListenerTaskEnd").alias("Event"), F.col("l_linenumber").cast("bigint").alias("Stage ID"),
        info.alias("Task Info"), metrics.alias("Task Metrics"),
    )
    start = F.struct(F.lit("SparkListenerTaskStart").alias("Event"), F.col("l_linenumber").alias("Stage ID"))
    return li.select(F.explode(F.array(F.to_json(end), F.to_json(start))).alias("value"))
