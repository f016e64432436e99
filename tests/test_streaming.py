"""Lines, change data, live state: edge rows, and stream equals batch."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayfare.catalog import views as v
from wayfare.functions import keys as rowkeys
from wayfare.operators import latest, tracks
from wayfare.operators.latest import upsert_latest, upsert_partial
from wayfare.session import scratch_path
from wayfare.sources import manifests, readers, sinks
from wayfare.sources.schema import ORDER_LINE
from wayfare.streaming import cdc, jobs, lines, metrics


def _lines(spark, *values):
    return spark.createDataFrame([(x,) for x in values], "value string")


GOOD_ORDER = "\t".join(str(i) for i in range(24))


def test_gps_lines(spark):
    got = lines.parse_gps(_lines(
        spark, "d,o,1475976000,104.1,30.5", "d,o,1475976000,104.1", "d,o,when,104.1,30.5", "end,o", "end",
        "d,weekend1,1475976001,104.1,30.5,more", "d,o,1,,", "",
    ))
    assert rows(got.select("order_id", "is_end")) == [("o", False), ("o", True), ("weekend1", False)]


def test_order_lines(spark):
    frame = _lines(
        spark, GOOD_ORDER, "\t".join("x" * 23), GOOD_ORDER.replace("23", ""), GOOD_ORDER + "\t\t",
        "\t".join(f"dwv_order_make_haikou.{c}" for c in ORDER_LINE),
    )
    got = lines.order_rows(frame)
    assert got.count() == 2 and got.first()["rowkey"] == "0_1211" and got.first()["day"] == "23"


def test_order_row_key_cleans_times(spark):
    cells = {c: "x" for c in ORDER_LINE} | {"departure_time": "2017-05-19 08:00:00", "arrive_time": "08:30:00"}
    got = lines.order_rows(_lines(spark, "\t".join(cells.values()))).first()
    assert got["rowkey"] == "x_20170519 08:00:00083000"


def test_routing_and_quarantine(spark):
    frame = _lines(spark, "d,o,1,104.1,30.5", "end,o", GOOD_ORDER, "a\tb", "noise", "d,o,x,1,2", "dwv_order_make_haikou\tx", None)
    assert rows(lines.route_lines(frame).groupBy("kind").count()) == [("gps", 2), ("order", 3)]
    good, bad = lines.quarantine(frame)
    assert good.count() == 3
    assert rows(bad.select("value", "reason")) == sorted([
        ("a\tb", "field_count"), ("noise", "unroutable"), ("d,o,x,1,2", "bad_number"), ("dwv_order_make_haikou\tx", "header"),
        (None, "unroutable"),
    ], key=repr)


def _points(spark, items):
    base = dt.datetime(2016, 10, 10)
    return spark.createDataFrame(
        [("d", o, base + dt.timedelta(minutes=m), float(m), float(m), e) for o, m, e in items],
        "driver_id string, order_id string, ts timestamp, lng double, lat double, is_end boolean",
    )


def test_trip_operators(spark):
    points = _points(spark, [
        ("a", 5, False), ("a", 65, False), ("a", 70, True), ("b", 3, False), ("b", 61, True), ("b", 62, False),
        ("c", 9, True), ("t", 4, False), ("t", 4, True),
    ])
    assert rows(tracks.active_orders(points)) == [("075_b", 2)]
    trips = {r["order_id"]: r for r in tracks.trip_state(points).collect()}
    assert set(trips) == {"a", "b", "t"} and trips["a"]["get_on_lng"] == 5.0 and trips["a"]["get_off_lat"] == 65.0
    assert rows(tracks.hourly_order_counts(points).select("order_count")) == [(3,)]
    track = tracks.track_history(points, tracks.trip_state(points), "075_a")
    assert track.count() == 2
    assert tracks.track_history(points, tracks.trip_state(points), "a", inclusive=False).count() == 1
    queue = tracks.position_queue(points).where("order_id = 'a'").orderBy("queue_index").collect()
    assert [(r["entry"], r["queue_index"]) for r in queue] == [("end", 0), ("65.0,65.0", 1), ("5.0,5.0", 2)]
    replayed = [r["entry"] for r in tracks.replay(points).where("order_id = 'a'").collect()]
    assert replayed == ["5.0,5.0", "65.0,65.0", "end"]
    assert tracks.first_position(points).where("order_id = 'b'").first()["lng"] == 3.0
    assert tracks.last_position(points).where("order_id = 'b'").first()["lng"] == 62.0


def test_queue_of_a_huge_order_matches_a_plain_ranking(spark):
    from pyspark.sql import Window

    points = spark.range(3000).selectExpr(
        "'d' as driver_id", "if(id % 3 = 0, 'hot', concat('o', id % 50)) as order_id",
        "timestamp_seconds(1476057600 + id * 7) as ts", "cast(id as double) as lng", "0.5D as lat", "id % 97 = 0 as is_end",
    )
    got = tracks.position_queue(points)
    w = Window.partitionBy("order_id").orderBy(F.col("ts").desc(), F.col("is_end").desc(), F.col("entry").desc())
    plain = tracks.queue_entries(points).select("order_id", "ts", "entry", (F.row_number().over(w) - 1).cast("bigint").alias("queue_index"))
    assert rows(got) == rows(plain)


# ---- merges ----

def test_upserts(spark):
    target = spark.createDataFrame([("1", 1, "a", "x"), ("2", 1, "b", None)], "id string, ver int, p string, q string")
    changes = spark.createDataFrame(
        [("1", 3, None, "z"), ("1", 2, "n", "y"), (None, 9, "no", "no"), ("3", 1, "c", None)], "id string, ver int, p string, q string"
    )
    assert rows(upsert_latest(target, changes, ["id"], ["ver"])) == [("1", 3, None, "z"), ("2", 1, "b", None), ("3", 1, "c", None)]
    assert rows(upsert_partial(target, changes, ["id"], "ver")) == [("1", 3, "n", "z"), ("2", 1, "b", None), ("3", 1, "c", None)]


def _envelopes(spark, *items):
    return spark.createDataFrame([(x, i) for i, x in enumerate(items)], "value string, offset bigint")


CDC = (
    '{"table":"order_info_2019","ts":5,"data":{"id_":"1","state":"late","pay_all":null}}',
    '{"table":"order_info","type":"update","ts":4,"data":{"id_":"1","state":"early"}}',
    '{"table":"order_info","type":"delete","ts":6,"data":{"id_":"2","state":"gone"}}',
    '{"table":"order_info","type":"insert","ts":1,"data":{"id_":"2","state":"born"}}',
    '{"table":"renter_info_x","ts":1,"data":{"id_":"9"}}', '{"table":"other","data":{"id_":"9"}}', "garbage", "[1]", None,
    '{"table":"renter_info","ts":1,"data":{"id_":"7","city_name":"A"}}',
)


def test_cdc_edges(spark):
    messages = _envelopes(spark, *CDC)
    parsed = cdc.parse(messages)
    assert rows(parsed.groupBy("entity", "op").count()) == [
        ("order_info", "delete", 1), ("order_info", "insert", 2), ("order_info", "update", 1), ("renter_info", "insert", 1),
    ]

    def states(mode):
        return rows(cdc.apply(messages, "order_info", mode).select("id", "state"))

    assert states("keep") == [("1", "late"), ("2", "gone")]
    assert states("drop") == [("1", "late")]
    assert states("ignore") == [("1", "late"), ("2", "born")]
    first = cdc.apply(messages, "order_info").where("id = '1'").first()
    assert first["pay_all"] == "" and first["rowkey"].startswith("0001") and first["operator_type"] == "insert"
    with pytest.raises(ValueError):
        cdc.apply(messages, "order_info", "maybe")


def test_cdc_order_does_not_depend_on_arrival(spark):
    ahead, back = _envelopes(spark, *CDC), _envelopes(spark, *CDC[::-1])
    assert rows(cdc.apply(ahead, "order_info")) == rows(cdc.apply(back, "order_info"))


# ---- streams over several small files ----

@pytest.fixture(scope="module")
def split_events(spark, data):
    """Events as eight time-ordered files, one per micro-batch."""
    path = scratch_path(spark, "split")
    events = spark.read.parquet(f"{data}/events.parquet")
    for i in range(8):
        events.where(F.floor(F.dayofmonth("ts") / 4) == i).coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, path):
    return readers.stream_files(spark, f"{path}/*.parquet", spark.read.parquet(path).schema, max_files=1)


def _live(spark, path):
    return lines.gps_events(v.gps_lines_of(_stream(spark, path)), "arrived_at")


def _settled(spark, state, name, keys):
    path = scratch_path(spark, name)
    query = jobs.start_state(state, f"{path}/out", f"{path}/checkpoint", name, interval=None)
    jobs.wait(query)
    assert len(query.recentProgress) >= 8
    return sinks.read_current(spark, f"{path}/out", keys)


def test_stream_state_equals_batch(spark, split_events):
    batch = lines.gps_events(v.gps_lines_of(spark.read.parquet(split_events)), "arrived_at")
    for build, name in ((tracks.trip_state, "trips"), (tracks.order_activity, "activity"), (jobs.first_seen, "first")):
        live = _settled(spark, build(_live(spark, split_events)), name, ["order_id"])
        want = build(batch)
        assert rows(live.select(*want.columns)) == rows(want)


def test_hourly_first_processed(spark, split_events):
    path = scratch_path(spark, "hourly-first")
    counts = jobs.hourly_first_processed(_live(spark, split_events))
    jobs.wait(jobs.start_state(counts, f"{path}/out", f"{path}/checkpoint", "hourly_first", mode="complete", interval=None))
    newest = sinks.read_current(spark, f"{path}/out", ["hour"])
    batch = lines.gps_events(v.gps_lines_of(spark.read.parquet(split_events)), "arrived_at")
    assert newest.agg(F.sum("order_count")).first()[0] == tracks.positions(batch).select("order_id").distinct().count()


def test_bounded_state_writes_closed_hours_once(spark, split_events):
    path = scratch_path(spark, "hourly-bounded")
    counts = jobs.hourly_first_processed(_live(spark, split_events), watermark="40 days")
    jobs.wait(jobs.append_stream(counts, f"{path}/out", f"{path}/checkpoint", "bounded", None))
    # all data lies within the watermark, so no hour is closed yet and none is written
    assert spark.read.schema("hour timestamp, order_count bigint").parquet(f"{path}/out").count() == 0
    short = scratch_path(spark, "hourly-short")
    counts = jobs.hourly_first_processed(_live(spark, split_events), watermark="1 hour")
    jobs.wait(jobs.append_stream(counts, f"{short}/out", f"{short}/checkpoint", "short", None))
    closed = spark.read.parquet(f"{short}/out")
    assert closed.count() > 0 and closed.groupBy("hour").count().where("count > 1").count() == 0


def test_routed_ingest_and_replay(spark, data):
    path = scratch_path(spark, "routed")
    v.mixed_lines(spark, data).repartition(3).write.parquet(f"{path}/in")
    source = readers.stream_files(spark, f"{path}/in/*.parquet", spark.read.parquet(f"{path}/in").schema)
    for _ in range(2):  # the second run finds nothing new
        jobs.wait(jobs.start_routed_ingest(source, f"{path}/out", f"{path}/checkpoint", None))
    good, bad = lines.quarantine(v.mixed_lines(spark, data))
    written = sinks.read_changes(spark, f"{path}/out/gps").drop(sinks.RUN, sinks.BATCH, sinks.WRITTEN)
    assert rows(written) == rows(lines.gps_rows(good))
    assert sinks.read_changes(spark, f"{path}/out/orders").count() == lines.order_rows(good).count()
    assert sinks.read_changes(spark, f"{path}/out/quarantine").count() == bad.count()


@pytest.mark.parametrize("start, tables", [(jobs.start_ingest, ("gps", "orders")), (jobs.start_routed_ingest, ("gps", "orders", "quarantine"))])
def test_tables_of_a_batch_are_made_from_files(spark, data, monkeypatch, start, tables):
    path, read, append = scratch_path(spark, "staged"), {}, jobs.append_changes

    def seen(rows, table, batch_id):
        read[table.rsplit("/", 1)[1]] = (rows.inputFiles(), rows.storageLevel.useMemory)
        append(rows, table, batch_id)

    monkeypatch.setattr(jobs, "append_changes", seen)
    jobs.wait(start(v.records_stream(spark, data), f"{path}/out", f"{path}/checkpoint", None))
    assert sorted(read) == sorted(tables)
    for files, in_memory in read.values():
        assert files and all(f"{path}/out/{sinks.STAGED}/" in f for f in files) and not in_memory
    assert manifests.Store(spark, f"{path}/out").names(sinks.STAGED) == []
    assert sinks.read_changes(spark, f"{path}/out/gps").count() == lines.gps_rows(v.gps_lines(spark, data)).count()


def test_a_batch_that_fails_leaves_no_files(spark, data, monkeypatch):
    path = scratch_path(spark, "staged")
    monkeypatch.setattr(sinks, "run_of", lambda batch: "run")
    with pytest.raises(RuntimeError):
        with sinks.staged(_lines(spark, "a", "b"), _lines(spark, "a", "b"), path, 3) as found:
            assert found.count() == 2
            raise RuntimeError
    assert manifests.Store(spark, path).names(sinks.STAGED) == []


def _rows_of(spark, *values):
    return spark.createDataFrame(list(values), "id string, v int")


def test_a_replayed_batch_replaces_itself(spark):
    path = scratch_path(spark, "replay")
    for value in (1, 2):
        sinks.append_changes(_rows_of(spark, ("k", value)), path, 0, "a")
    sinks.append_changes(_rows_of(spark, ("k", 5), ("m", 6)), path, 1, "a")
    assert rows(sinks.read_current(spark, path, ["id"])) == [("k", 5), ("m", 6)]
    assert sinks.read_changes(spark, path).count() == 3


def test_compaction_keeps_all_keys_of_all_runs(spark):
    path = scratch_path(spark, "compact")
    sinks.append_changes(_rows_of(spark, ("k", 1), ("l", 1)), path, 0, "a")
    sinks.append_changes(_rows_of(spark, ("k", 2)), path, 1, "a")
    sinks.compact(spark, path, ["id"])
    assert rows(sinks.read_current(spark, path, ["id"])) == [("k", 2), ("l", 1)]
    assert sinks.read_changes(spark, path).count() == 2
    # a stream with a new checkpoint begins at batch 0 again, and the old one goes on
    sinks.append_changes(_rows_of(spark, ("m", 7)), path, 0, "b")
    sinks.append_changes(_rows_of(spark, ("l", 8)), path, 2, "a")
    assert rows(sinks.read_current(spark, path, ["id"])) == [("k", 2), ("l", 8), ("m", 7)]
    sinks.compact(spark, path, ["id"])
    sinks.compact(spark, path, ["id"])
    assert rows(sinks.read_current(spark, path, ["id"])) == [("k", 2), ("l", 8), ("m", 7)]
    assert sinks.read_changes(spark, path).count() == 3


def test_streams_with_a_new_checkpoint_lose_no_key(spark, data):
    path = scratch_path(spark, "restart")
    for i in range(2):
        v.table(spark, data, "orders").where(f"o_orderkey % 2 = {i}").write.parquet(f"{path}/in-{i}")
        source = readers.stream_files(spark, f"{path}/in-{i}", v.table(spark, data, "orders").schema)
        for _ in range(2):  # the second start finds the checkpoint and nothing new
            jobs.wait(jobs.start_cdc(v.order_changes_of(source), f"{path}/out", f"{path}/checkpoint-{i}", None, compact_every=1))
    live = sinks.read_current(spark, f"{path}/out/{cdc.ORDER_TABLE}", ["id"], ["ts", "offset"])
    want = cdc.newest_images(cdc.entity_rows(cdc.parse(v.order_changes_of(v.table(spark, data, "orders"))), cdc.ORDER_TABLE))
    assert rows(live.select(*want.columns)) == rows(want)
    assert live.count() > 0 and live.where(~F.col("rowkey").eqNullSafe(rowkeys.salted_key(F.col("id")))).count() == 0


def test_a_failed_report_leaves_the_old_one(spark):
    path = scratch_path(spark, "versions")
    sinks.write_report(_rows_of(spark, ("k", 1), (None, 2)), path, "id")
    broken = spark.range(3).selectExpr("cast(id as string) as id", "cast(raise_error('no') as int) as v")
    with pytest.raises(Exception, match="no"):
        sinks.write_report(broken, path, "id")
    assert rows(sinks.read_report(spark, path)) == [("k", 1)]
    sinks.write_report(_rows_of(spark, ("n", 3)), path, "id")
    assert rows(sinks.read_report(spark, path)) == [("n", 3)]


def test_reports_are_upserted_by_key(spark):
    path = scratch_path(spark, "upserts")
    for day, values in (("1", [("a", 1), ("b", 1), ("b", 2)]), ("2", [("b", 5), ("c", 6)])):
        sinks.upsert_report(_rows_of(spark, *values).selectExpr("id", f"'{day}' as day", "v"), path, ["id"], ["day"])
    assert rows(sinks.read_report(spark, path)) == [("a", "1", 1), ("b", "2", 5), ("c", "2", 6)]


def test_a_folder_is_streamed_without_its_neighbours(spark):
    path = scratch_path(spark, "neighbours")
    _rows_of(spark, ("a", 1), ("b", 2), ("c", 3)).coalesce(1).write.parquet(f"{path}/order")
    _rows_of(spark, ("x", 1)).write.parquet(f"{path}/order_old")
    one = [f.path for f in spark.read.format("binaryFile").load(f"{path}/order/*.parquet").select("path").collect()]
    for i, source in enumerate([f"{path}/order", f"{path}/order/", *one]):
        stream = readers.stream_files(spark, source, spark.read.parquet(f"{path}/order").schema)
        jobs.wait(jobs.append_stream(stream, f"{path}/out{i}", f"{path}/checkpoint{i}", f"neighbours{i}", None))
        assert rows(spark.read.parquet(f"{path}/out{i}")) == [("a", 1), ("b", 2), ("c", 3)]


def test_every_line_ends_as_a_row_or_a_reason(spark, data):
    odd = ["end,", "end,,", "end", "", "end,7", "1,2,3,4,5,", "a\tb", "1,o,5,x,y"]
    frame = v.mixed_lines(spark, data).unionByName(spark.createDataFrame([(x,) for x in odd], "value string"))
    good, bad = lines.quarantine(frame)
    n_rows = lines.parse_gps(lines_of_kind(good, "gps")).count() + lines.parse_order_lines(lines_of_kind(good, "order")).count()
    assert n_rows + bad.count() == frame.count()
    assert {r["value"] for r in bad.where("reason = 'end_without_order'").collect()} == {"end,", "end,,"}


def lines_of_kind(good, kind):
    marker = lines.is_end_marker(F.col("value"))
    gps = marker | (lines.line_kind(F.col("value")) == "gps")
    return good.where(F.coalesce(gps, F.lit(False)) if kind == "gps" else ~F.coalesce(gps, F.lit(False)))


def test_every_message_ends_as_an_image_or_a_reason(spark, data):
    messages = v.changes(spark, data).unionByName(v.broken_changes(spark, data))
    assert cdc.parse(messages).count() + cdc.quarantine(messages).count() == messages.count()
    assert cdc.parse(messages).where("id = ''").count() == 0


def test_cdc_stream_equals_batch(spark, data):
    path = scratch_path(spark, "cdc-test")
    changes = v.changes(spark, data)
    changes.repartition(4).write.parquet(f"{path}/in")
    source = readers.stream_files(spark, f"{path}/in/*.parquet", changes.schema, max_files=1)
    jobs.wait(jobs.start_cdc(source, f"{path}/out", f"{path}/checkpoint", None))
    for entity in cdc.TABLE_COLUMNS:
        live = sinks.read_current(spark, f"{path}/out/{entity}", ["id"], ["ts", "offset"])
        want = cdc.newest_images(cdc.entity_rows(cdc.parse(changes), entity))
        assert rows(live.select(*want.columns)) == rows(want)


# ---- metrics ----

def test_recorder_and_flags(spark, split_events):
    path = scratch_path(spark, "recorded")
    recorder = metrics.ProgressRecorder(spark, f"{path}/events", flush_every=3)
    spark.streams.addListener(recorder)
    try:
        query = jobs.append_stream(_stream(spark, split_events), f"{path}/out", f"{path}/checkpoint", "recorded", None)
        jobs.wait(query)
        recorder.wait_for(query)
    finally:
        spark.streams.removeListener(recorder)
    kinds = {r["event"] for r in recorder.events().collect()}
    assert "progress" in kinds and "started" in kinds
    flagged = metrics.progress_flags(recorder.progress(), blocked_ms=0)
    busy = flagged.where("num_input_rows > 0 and query_name = 'recorded'").collect()
    assert busy and all(r["is_blocked"] and r["total_duration_ms"] >= r["add_batch_ms"] for r in busy)
    assert all(r["gc_percent"] >= 0 for r in busy)


def test_task_metrics_of_a_real_event_log(spark):
    spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count().collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    tasks = metrics.task_metrics(metrics.read_event_log(spark, spark.event_dir))
    assert tasks.count() > 0 and tasks.where("duration_ms < 0 or run_ms is null").count() == 0
    stages = metrics.stage_metrics(tasks)
    assert stages.agg(F.sum("n_tasks")).first()[0] == tasks.count()


def test_ratios(spark):
    names = ["snapshot_ms", *sum(metrics.RATIO_PANELS.values(), ()), "mem_used_mb", "remaining_mem_mb", "max_mem_mb"]
    df = spark.createDataFrame([(1, 1, 1, 1, 0, 0, 0, 25, 75, 100), (2, 1, 7, 792, 1, 1, 2, 0, 0, 9)], ", ".join(f"{n} bigint" for n in names))
    got = {r["snapshot_ms"]: r for r in metrics.metrics_ratios(df).collect()}
    assert got[1]["failed_stages_percent"] == 33.33 and got[1]["running_batches_percent"] == 0.0
    assert got[1]["max_mem_mb_percent"] == 100.0 and got[2]["failed_stages_percent"] == 0.12 and got[2]["max_mem_mb_percent"] == 0.0


def test_progress_of_more_batches_than_spark_keeps(spark):
    """Spark itself forgets progress after 100 batches; the table has all of it, of both sources."""
    path = scratch_path(spark, "many")
    for side in ("a", "b"):
        spark.range(110).repartition(110, "id").write.parquet(f"{path}/{side}")
    schema = spark.read.parquet(f"{path}/a").schema
    both = [readers.stream_files(spark, f"{path}/{side}", schema, max_files=1) for side in ("a", "b")]
    # a batch reads a file of each side; Spark may write files without rows, also as the first one
    n_files = max(spark.read.parquet(f"{path}/{s}").select(F.input_file_name()).distinct().count() for s in ("a", "b"))
    recorder = metrics.ProgressRecorder(spark, f"{path}/events", flush_every=40)
    spark.streams.addListener(recorder)
    try:
        writer = both[0].union(both[1]).writeStream.queryName("many").format("noop").option("checkpointLocation", f"{path}/checkpoint")
        query = writer.trigger(availableNow=True).start()
        jobs.wait(query)
        recorder.wait_for(query)
    finally:
        spark.streams.removeListener(recorder)
    events = recorder.events().where(F.col("query_id") == str(query.id)).where("event = 'progress'")
    assert metrics.flatten_progress(events).agg(F.sum("num_input_rows")).first()[0] == 220
    assert metrics.flatten_progress(events).where("num_input_rows > 0").count() >= n_files
    sources = metrics.progress_sources(events).groupBy("source_index").agg(F.sum("source_rows").alias("n")).collect()
    assert sorted((r["source_index"], r["n"]) for r in sources) == [(0, 110), (1, 110)]
    assert recorder.events(last_seconds=3600).count() == recorder.events().count()
    assert recorder.events(last_seconds=0).count() == 0


def test_event_logs_in_any_spelling(spark):
    texts = [
        '{"Event":"SparkListenerTaskEnd","Stage ID":1,"Task Info":{"Launch Time":1,"Finish Time":5}}',
        '{ "Stage ID" : 2, "Task Info": {"Finish Time": 9, "Launch Time": 1}, "Event" : "SparkListenerTaskEnd" }',
        '{"Event":"Other","Note":"SparkListenerTaskEnd"}', "not json SparkListenerTaskEnd",
    ]
    found = metrics.task_metrics(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert rows(found.select("stage_id", "duration_ms")) == [(1, 4), (2, 8)]


def test_newest_rows_are_repeatable(spark):
    frame = spark.createDataFrame([(1, i) for i in range(20)], "t int, x int")
    assert rows(latest.newest_rows(frame.repartition(7), "t", 3)) == [(1, 17), (1, 18), (1, 19)]


def test_trips_close_and_their_state_goes(spark):
    """Four hours of short trips: each is written once, and state holds the running ones, not all that ever ran."""
    path = scratch_path(spark, "closing")
    start = dt.datetime(2024, 1, 1)
    for part in range(4):
        values = []
        for trip in range(60):
            begin = start + dt.timedelta(hours=part, seconds=60 * trip)
            values += [("d", f"o{part}-{trip}", begin + dt.timedelta(seconds=10 * k), 104.0 + k, 30.0, False) for k in range(5)]
            if trip % 2:
                values.append((None, f"o{part}-{trip}", begin + dt.timedelta(seconds=60), None, None, True))
        frame = spark.createDataFrame(values, "driver_id string, order_id string, ts timestamp, lng double, lat double, is_end boolean")
        frame.coalesce(1).write.mode("append").parquet(f"{path}/in")
    live = readers.stream_files(spark, f"{path}/in/*.parquet", frame.schema, max_files=1)
    query = jobs.start_trip_closing(live, f"{path}/out", f"{path}/checkpoint", "10 minutes", "20 minutes", None)
    states = []
    jobs.wait(query)
    for progress in query.recentProgress:
        states += [s["numRowsTotal"] for s in json.loads(progress.json)["stateOperators"]]
    closed = spark.read.parquet(f"{path}/out")
    assert closed.count() == closed.select("order_id").distinct().count() > 200
    assert max(states) < 130 and states[-1] < 40  # 240 trips ran in all
    whole = tracks.closed_trips(spark.read.parquet(f"{path}/in"), "20 minutes")
    assert whole.count() == 240 and rows(whole.join(closed.select("order_id"), "order_id", "left_semi").select(*closed.columns)) == rows(closed)
    assert closed.where("has_end").agg(F.min("n_points"), F.max("n_points")).first()[:] == (5, 5)


def test_delete_modes_of_streams(spark):
    messages = _envelopes(spark, *CDC)
    path = scratch_path(spark, "deletes")
    messages.write.parquet(f"{path}/in")
    for mode in cdc.DELETE_MODES:
        live = readers.stream_files(spark, f"{path}/in/*.parquet", messages.schema)
        jobs.wait(jobs.start_cdc(live, f"{path}/{mode}", f"{path}/checkpoint-{mode}", None, deletes=mode))
        got = jobs.read_applied(spark, f"{path}/{mode}", cdc.ORDER_TABLE, mode).select("id", "state")
        assert rows(got) == rows(cdc.apply(messages, cdc.ORDER_TABLE, mode).select("id", "state"))
    by_mode = cdc.images_by_mode(cdc.entity_rows(cdc.parse(messages), cdc.ORDER_TABLE))
    for mode in cdc.DELETE_MODES:
        want = cdc.apply(messages, cdc.ORDER_TABLE, mode).select("id", "state")
        assert rows(by_mode.where(F.col("mode") == mode).select("id", "state")) == rows(want)


def test_the_recorder_writes_after_a_time(spark):
    recorder = metrics.ProgressRecorder(spark, scratch_path(spark, "timed"), flush_every=1000, flush_seconds=0)
    recorder._note("progress", "q", "{}", 1)
    assert recorder.events().count() == 1
    recorder._gc_before = 0
    assert recorder._gc_since() >= 0 and recorder._gc_since() < 10_000
