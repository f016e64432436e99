"""Daily partial results, rolling distinct users, and queues kept by a stream: against whole passes and brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayfare.catalog import views as v
from wayfare.operators import tracks
from wayfare.plans import batch, partials, reports, rolling
from wayfare.session import scratch_path
from wayfare.sources import manifests, readers, sinks
from wayfare.streaming import jobs, queue

DAY = v.ORDERS_AS_OF


def _plain(spark, seed=1, n=600):
    """Orders over some weeks with missing keys, times and flags."""
    rng, start = random.Random(seed), dt.datetime(1998, 6, 20)
    values = []
    for i in range(n):
        ts = start + dt.timedelta(minutes=rng.randrange(60 * 24 * 40))
        values.append((
            str(i), ts, float(rng.randrange(100)), float(rng.randrange(9)), rng.choice(["A", "B", "", None]), rng.choice(["d1", "d2", None]),
            rng.choice(["Ann", "Bo", None]), rng.choice(["460101", "460202", None]), rng.choice(["V1", "V2", "V3", None]), rng.randrange(2),
        ))
    return spark.createDataFrame(values, (
        "id string, create_time timestamp, pay_all double, charge_mileage double, city_name string, driver_id string, driver_name string, "
        "begin_address_code string, vehicle_license string, cancel int"))


FULL = {
    "completion_city": (reports.completion_by_city, partials.completion_by_city), "completion_driver": (reports.completion_by_driver, partials.completion_by_driver),
    "region_orders": (reports.region_orders, partials.region_orders), "platform": (reports.platform_totals, partials.platform_totals),
}


@pytest.mark.parametrize("name", FULL)
def test_partials_equal_the_whole_report(spark, name):
    facts = _plain(spark)
    path = scratch_path(spark, "partials")
    partials.update_days(facts, path, name, "1998-06-20", "1998-07-31")
    whole, merged = FULL[name]
    for as_of in (DAY, "1998-06-30", "1998-07-29"):
        want = whole(facts, as_of)
        assert rows(merged(spark, path, as_of).select(*want.columns)) == rows(want)
    # late facts of one day and facts that are gone from another: these days are done again, no other one
    changed = facts.where("date(create_time) <> '1998-07-14'").unionByName(_plain(spark, 2, 300).where("date(create_time) = '1998-07-15'"))
    for day in ("1998-07-14", DAY):
        partials.update_days(changed, path, name, day)
    want = whole(changed, DAY)
    assert rows(merged(spark, path, DAY).select(*want.columns)) == rows(want)


def test_a_new_day_reads_its_facts_and_rewrites_its_range_only(spark):
    path = scratch_path(spark, "one-day")
    _plain(spark).write.parquet(f"{path}/facts")
    facts = spark.read.parquet(f"{path}/facts")
    partials.update_days(facts, path, "region_orders", "1998-06-20", "1998-07-31")
    before = {p.bucket: p.folder for p in manifests.newest(spark, f"{path}/region_orders").parts}
    partials.update_days(facts, path, "region_orders", DAY)
    after = {p.bucket: p.folder for p in manifests.newest(spark, f"{path}/region_orders").parts}
    assert len(before) > 8 and 1 <= sum(before[b] != after[b] for b in before) <= 2
    wanted = facts.where((F.col("create_time") >= DAY) & (F.col("create_time") < "1998-07-16"))
    plan = partials.PARTIALS["region_orders"].build(wanted)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Filter") :]
    assert "create_time" in below and "1998-07-15" in below and "1998-07-16" in below and "Relation" in below


def test_ranges_are_replaced(spark):
    path = scratch_path(spark, "ranges")
    frame = lambda *values: spark.createDataFrame(list(values), "k string, v int")
    sinks.replace_range(frame(*[(f"{i:02d}", i) for i in range(40)]), path, ["k"], "00", "99", buckets=4)
    sinks.replace_range(frame(("11", -1), ("55", -2), (None, 0)), path, ["k"], "10", "20")  # 55 is outside
    want = [(f"{i:02d}", i) for i in range(10)] + [("11", -1)] + [(f"{i:02d}", i) for i in range(20, 40)]
    assert rows(sinks.read_report(spark, path)) == want
    sinks.replace_range(frame(("11", 1)).limit(0), path, ["k"], "00", "25")
    assert rows(sinks.read_report(spark, path)) == [(f"{i:02d}", i) for i in range(25, 40)]


def test_the_batch_keeps_one_row_per_key(spark):
    path = scratch_path(spark, "batch")
    frame = lambda *values: spark.createDataFrame(list(values), "order_id string, name string")
    days = {"1": frame(("a", "x"), ("a", "y"), ("b", "x")), "2": frame(("a", "w"), ("c", "x"), (None, "x"))}
    for day, stations in days.items():
        assert batch.upsert_all({"virtual_stations": batch.Outcome(frame=stations), "income": batch.Outcome(error="no source")}, path, day) == {
            "virtual_stations": None, "income": "no source"}
    assert rows(sinks.read_report(spark, f"{path}/virtual_stations")) == [("a", "w", "2"), ("b", "x", "1"), ("c", "x", "2")]


def _logons(seed=3):
    rng, start = random.Random(seed), dt.datetime(2024, 1, 1)
    return [(rng.choice([None, *[f"u{i}" for i in range(90)]]), start + dt.timedelta(hours=rng.randrange(24 * 50))) for _ in range(700)] + [("u1", None)]


@pytest.mark.parametrize("users, places", [(24_000, 32768), (7, 32768)])
def test_rolling_users(spark, monkeypatch, users, places):
    monkeypatch.setattr(rolling, "USERS_PER_BUCKET", users)
    logons = _logons()
    got = rolling.rolling_active_users(spark.createDataFrame(logons, "user string, ts timestamp"), "user", "ts", "2024-02-10", 60)
    days = {(u, t.date()) for u, t in logons if u and t}
    want = []
    for n in range(60):
        day = dt.date(2024, 2, 10) - dt.timedelta(days=n)
        counts = [len({u for u, d in days if 0 <= (day - d).days < span}) for span in (1, 7, 30)]
        want.append((day, *counts))
    assert rows(got.select("day", "DAU", "WAU", "MAU")) == sorted(want, key=repr)


def test_more_users_in_a_bucket_than_a_bitmap_has_places(spark):
    users = spark.range(70_000).selectExpr("cast(id as string) as user", "timestamp'2024-01-01 10:00:00' as ts")
    places = rolling.user_places(users, "user", n_users=1)  # a wrong guess: one bucket for all
    assert places.agg(F.count_distinct("bucket", "place")).first()[0] == 70_000 and places.agg(F.max("place")).first()[0] < 32768
    counted = rolling.rolling_counts(rolling.daily_bitmaps(users, places, "user", "ts"), "2024-01-01", "2024-01-02")
    assert rows(counted.select("DAU", "WAU", "MAU")) == [(0, 70_000, 70_000), (70_000, 70_000, 70_000)]


def test_nobody_logged_on(spark):
    none = spark.createDataFrame([], "user string, ts timestamp")
    assert rolling.rolling_active_users(none, "user", "ts", "2024-01-10", 3).count() == 3
    assert rolling.rolling_active_users(none, "user", "ts", "2024-01-10", 3).agg(F.sum("MAU")).first()[0] == 0


def _points(spark, n=3000):
    """One order holds most of the points; times repeat."""
    rng, start = random.Random(5), dt.datetime(2024, 1, 1)
    values = []
    for i in range(n):
        order = "hot" if i % 3 else f"o{rng.randrange(20)}"
        values.append(("d", order, start + dt.timedelta(seconds=rng.randrange(3600)), 104 + i / 1e4, 30.0 + i / 1e4, i % 50 == 0))
    return spark.createDataFrame(values, "driver_id string, order_id string, ts timestamp, lng double, lat double, is_end boolean")


def test_a_queue_kept_by_a_stream(spark):
    points, path = _points(spark), scratch_path(spark, "queue")
    points.repartition(6).write.parquet(f"{path}/in")
    for _ in range(2):  # the second start finds nothing new
        live = readers.stream_files(spark, f"{path}/in/*.parquet", points.schema, max_files=1)
        jobs.wait(queue.start_position_queue(live, f"{path}/out", f"{path}/checkpoint", None, fan=3))
    want = tracks.position_queue(points)
    assert rows(queue.read_queue(spark, f"{path}/out")) == rows(want)
    assert rows(queue.read_queue(spark, f"{path}/out", newest=4)) == rows(want.where("queue_index < 4"))
    assert rows(queue.read_queue(spark, f"{path}/out", "hot", 7)) == rows(want.where("order_id = 'hot' and queue_index < 7"))
    # the hot order is ranked in as many groups as it has minutes
    assert queue.segmented(points).where("order_id = 'hot'").select("segment").distinct().count() == 60
    assert len(manifests.newest(spark, f"{path}/out/entries").parts) <= 3
