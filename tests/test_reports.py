"""Reports: one pass equals joins; edge rows; formats."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.join_forms import PAIRS
from wayfare.functions import text as txt
from wayfare.operators.counting import distinct_where
from wayfare.operators.periods import Periods, filter_period
from wayfare.plans import batch, hot, reports, serving
from wayfare.sources.schema import typed


@pytest.mark.parametrize("name", sorted(PAIRS))
def test_one_pass_equals_joins(spark, data, name):
    frames = {form: build(spark, data) for form, build in PAIRS[name].items()}
    names = sorted(frames["one_pass"].columns)
    got, want = (rows(frames[f].select(*names)) for f in ("one_pass", "joins"))
    assert got == want and got


RAW = "id string, create_time string, cancel string, city_name string, driver_id string, driver_name string, pay_all string"


def _orders(spark, items):
    return typed(spark.createDataFrame(items, RAW), "order")


def test_empty_cells_do_not_break_reports(spark):
    orders = _orders(spark, [
        ("1", "2019-07-15 08:00:00", "0", "A", "d1", "Ann", "10.5"),
        ("2", "2019-07-15 09:00:00", "", "A", "d1", "Ann", ""),
        ("3", "", "0", "A", "d1", "Ann", "x"),
        ("4", "2019-07-15 23:59:59", "2", "B", "d2", "Bob", "1"),
    ])
    got = rows(reports.completion_by_city(orders, "2019-07-15"))
    assert got == [("1", "A", "50.0%", "50.0%", "50.0%", "50.0%", "50.0%")]


def test_driver_with_two_names_is_one_row(spark):
    orders = _orders(spark, [
        ("1", "2019-07-14 08:00:00", "0", "A", "d1", "Old", "1"),
        ("2", "2019-07-15 09:00:00", "0", "A", "d1", "New", "1"),
        ("3", "2019-07-15 10:00:00", "1", "A", "d1", "New", "1"),
    ])
    got = rows(reports.completion_by_driver(orders, "2019-07-15"))
    # the 14th is a Sunday, so it belongs to the week before
    assert got == [("d1", "d1", "New", "66.67%", "66.67%", "66.67%", "50.0%", "50.0%")]


def test_week_ignores_or_minds_the_year(spark):
    days = spark.createDataFrame(
        [(dt.datetime(2018, 12, 31),), (dt.datetime(2019, 1, 2),), (dt.datetime(2019, 12, 30),), (dt.datetime(2019, 1, 7),)],
        "ts timestamp",
    )
    assert filter_period(days, "ts", "week", "2019-01-02").count() == 3
    assert filter_period(days, "ts", "week", "2019-01-02", "iso_year").count() == 2
    assert filter_period(days, "ts", "quarter", "2019-12-31").count() == 1


@pytest.mark.parametrize("as_of", ["2019-01-01", "2019-12-31", "2020-02-29", "2019-07-15", "2020-12-30"])
def test_scan_ranges_hold_all_rows_of_their_periods(spark, as_of):
    # fifty years around, so that times beyond the spelled-out years are met as well
    base = dt.datetime(1995, 1, 1)
    days = spark.createDataFrame([(base + dt.timedelta(days=i, hours=5),) for i in range(18000)], "ts timestamp")
    for mode in ("any_year", "iso_year"):
        p, ts = Periods.of(as_of, mode), F.col("ts")
        for names in (("year", "quarter", "month", "week", "day"), ("month", "week", "day"), ("week",)):
            wanted = F.greatest(*[p.during(n, ts).cast("int") for n in names], F.lit(0)) == 1
            assert days.where(wanted & ~p.any_of(names, ts)).count() == 0
        for n in ("year", "quarter", "month", "week", "day"):
            assert filter_period(days, "ts", n, as_of, mode).count() == days.where(p.during(n, ts)).count() > 0


def test_period_filter_reaches_the_scan(spark, data):
    df = filter_period(spark.read.parquet(f"{data}/lineitem.parquet"), "l_shipdate", "month", "1998-07-15")
    plan = df.select("l_orderkey")._jdf.queryExecution().toString()
    weeks = filter_period(spark.read.parquet(f"{data}/lineitem.parquet"), "l_shipdate", "week", "1998-07-15")
    assert "PushedFilters: [IsNotNull(l_shipdate), Or(" in weeks._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "ReadSchema: struct<l_orderkey:bigint,l_shipdate" in plan


RENTER = "id string, create_time timestamp, last_logon_time timestamp, last_login_city string"
JULY = [dt.datetime(2019, 7, d, 12) for d in range(1, 32)]


def test_retention_formats_and_empty_cohort(spark):
    users = spark.createDataFrame(
        [(str(i), JULY[13], JULY[14] if i < 1 else None, "4600") for i in range(4)]
        + [(f"w{i}", JULY[6], JULY[14] if i < 1 else None, "") for i in range(3)],
        RENTER,
    )
    pairs = {"month": ("2019-06-15", "2019-07-15"), "week": ("2019-07-07", "2019-07-15"), "day": ("2019-07-14", "2019-07-15")}
    assert rows(reports.retention(users, pairs)) == [("1", "0.0%", "33.333333333333336%", "25.00%")]


def test_retention_counts_like_a_join_when_ids_repeat(spark):
    users = spark.createDataFrame(
        [("a", JULY[13], None, "x"), ("a", JULY[13], JULY[14], "x"), ("a", None, JULY[14], "x"), ("b", JULY[13], None, "x")],
        RENTER,
    )
    got = reports.retention_counts(users, {"day": ("2019-07-14", "2019-07-15")}).collect()[0]
    assert (got["day_cohort"], got["day_kept"]) == (5, 4)


def test_region_users_skips_unknown_city(spark):
    users = spark.createDataFrame(
        [("1", JULY[14], JULY[14], "460107"), ("2", JULY[14], None, ""), ("3", JULY[1], JULY[14], "460200"), ("4", JULY[1], None, "4603")],
        RENTER,
    )
    assert rows(reports.region_users(users, "2019-07-15")) == [("460100", "460100", 1, 1), ("460200", "460200", 0, 1)]


def test_distinct_in_two_steps_equals_count_distinct(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "case when id % 11 = 0 then null else id % 13 end as x", "id")
    got = distinct_where(df, ["k"], "x", {"small": F.col("id") < 100, "all": F.lit(True)})
    want = df.groupBy("k").agg(
        F.count_distinct(F.when(F.col("id") < 100, F.col("x"))).alias("small"), F.count_distinct("x").alias("all")
    )
    assert rows(got) == rows(want)


def test_percent_texts(spark):
    df = spark.createDataFrame([(1, 3), (3, 3), (0, 3), (0, 0)], "p bigint, w bigint")
    part, whole = F.col("p"), F.col("w")
    got = df.select(txt.percent_rounded(part, whole), txt.percent_decimal(part, whole), txt.percent_raw(part, whole))
    assert [tuple(r) for r in got.collect()] == [
        ("33.33%", "33.33%", "33.333333333333336%"), ("100.0%", "100.00%", "100.0%"), ("0.0%", "0.00%", "0.0%"),
        ("0.0%", None, None),
    ]


def test_hot_cells_change(spark):
    def at(day, lng, code, i):
        return (str(i), dt.datetime(2019, 7, day, 10, i), 20.0, lng, code)

    orders = spark.createDataFrame(
        [at(15, 110.0, "460101", 1), at(15, 110.0, "460102", 2), at(15, 110.2, "460102", 3), at(14, 110.2, "460102", 4),
         at(14, 110.4, "460102", 5), at(14, 110.6, "460109", 6)],
        "id string, create_time timestamp, open_lat double, open_lng double, begin_address_code string",
    )
    # two cells today, both named 460102; one of them is new, one cell is gone; 460109 has none today
    assert rows(hot.hot_cells(orders, "2019-07-15")) == [("460102", "460102", 2, 0)]
    assert sorted(r["count"] for r in hot.hot_change(orders, "2019-07-15").collect()) == [-1, -1, 0, 1]


def test_batch_isolates_failures_and_writes(spark, data, tmp_path):
    from wayfare.catalog import views as v

    sources = {"order": v.orders(spark, data), "renter": v.renters(spark, data), "driver": v.drivers(spark, data).drop("register_city")}
    outcomes = batch.run_all(sources, v.ORDERS_AS_OF)
    assert outcomes["driver_registrations"].frame is None and outcomes["driver_registrations"].error
    wanted = {k: outcomes[k] for k in ("completion_city", "income", "driver_registrations")}
    errors = batch.write_all(wanted, str(tmp_path))
    assert errors["completion_city"] is None and errors["driver_registrations"]
    served = serving.serve(spark.read.parquet(f"{tmp_path}/completion_city"), "completion_city")
    assert served.columns[0] == "city_name" and {t for _, t in served.dtypes} == {"string"}


def test_cached_sources_are_released(spark):
    df = spark.range(10)
    with batch.cached(df) as (kept,):
        assert kept.count() == 10 and kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_named_views_live_only_inside(spark):
    sources = {"order": spark.range(3), "renter": spark.range(2)}
    with batch.named_views(sources) as frames:
        assert spark.sql("select count(*) from `order`").first()[0] == 3
        assert frames["renter"].storageLevel.useMemory
    assert not spark.catalog.tableExists("renter")
