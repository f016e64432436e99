"""The reports in their plain form: one aggregation per period, joined afterwards.

Used to prove the one-pass reports and to time them against this form.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.catalog import views as v
from wayfare.catalog.queries import DAY, DRIVER_DAY, PAIRS as RETENTION_PAIRS, RENTER_DAY
from wayfare.functions import text as txt
from wayfare.operators.periods import NAMES, Periods, effective, on_day
from wayfare.plans import hot, reports


def _in(df: DataFrame, name: str, as_of: str, ts: str = "create_time") -> DataFrame:
    return df.where(Periods.of(as_of).during(name, F.col(ts)))


def _left(frames: list[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "left"), frames)


def completion(orders: DataFrame, key: str, as_of: str, rk=None) -> DataFrame:
    def status(name: str) -> DataFrame:
        period = _in(orders, name, as_of)
        done = period.where(effective(F.col("cancel"))).groupBy(key).agg(F.count(F.lit(1)).alias("e"))
        total = period.groupBy(key).agg(F.count(F.lit(1)).alias("t"))
        rate = txt.percent_rounded(F.col("e"), F.col("t")).alias(f"_{name}_comple_rate")
        return done.join(total, key, "left").select(key, rate)

    columns = [f"_{n}_comple_rate" for n in NAMES]
    return _left([status(n) for n in NAMES], key).fillna("0.0%", columns[1:]).select(key, *columns)


def registrations(drivers: DataFrame, as_of: str) -> DataFrame:
    def count(name: str) -> DataFrame:
        return _in(drivers, name, as_of).groupBy("register_city").agg(
            F.count_distinct("id").alias(f"_register_{name}_num")
        )

    return _left([count(n) for n in NAMES], "register_city").fillna(0)


def region_orders(orders: DataFrame, as_of: str) -> DataFrame:
    coded = orders.withColumn("region", txt.region4(F.col("begin_address_code")))

    def vehicles(name: str) -> DataFrame:
        return _in(coded, name, as_of).groupBy("region").agg(
            F.count_distinct("vehicle_license").alias(f"{name}VehicleCount")
        )

    def counts(name: str) -> DataFrame:
        return _in(coded, name, as_of).groupBy("region").agg(F.count(F.lit(1)).alias(f"{name}OrderCount"))

    left = _left([vehicles("month"), vehicles("day")], "region")
    right = _left([counts("month"), counts("week"), counts("day")], "region")
    return left.join(right, "region", "full").fillna(0).select(
        txt.region6(F.col("region")).alias("rk"), "monthVehicleCount", "dayVehicleCount",
        "monthOrderCount", "weekOrderCount", "dayOrderCount",
    )


def region_users(renters: DataFrame, as_of: str) -> DataFrame:
    known = renters.where(F.col("last_login_city") != "").withColumn("r", txt.region4(F.col("last_login_city")))
    new = known.where(on_day(F.col("create_time"), as_of)).groupBy("r").agg(F.count(F.lit(1)).alias("_day_new_user"))
    active = known.where(on_day(F.col("last_logon_time"), as_of)).groupBy("r").agg(F.count_distinct("id").alias("DAU"))
    return new.join(active, "r", "full").fillna(0).select(txt.region6(F.col("r")).alias("rk"), "_day_new_user", "DAU")


def retention(renters: DataFrame, pairs) -> DataFrame:
    formats = {"month": txt.percent_raw, "week": txt.percent_raw, "day": txt.percent_decimal}

    def one(name: str) -> DataFrame:
        cohort_day, active_day = pairs[name]
        cohort = renters.where(on_day(F.col("create_time"), cohort_day)).select("id")
        active = renters.where(on_day(F.col("last_logon_time"), active_day)).select("id", F.lit(1).alias("seen"))
        joined = cohort.join(active, "id", "left").agg(F.count("seen").alias("k"), F.count("id").alias("n"))
        rate = F.coalesce(formats[name](F.col("k"), F.col("n")), F.lit("0.0%"))
        return joined.select(F.lit("1").alias("myid"), rate.alias(f"{name}StateRate"))

    return reduce(lambda a, b: a.join(b, "myid", "full"), [one(n) for n in ("month", "week", "day")])


def active_users(renters: DataFrame, as_of: str) -> DataFrame:
    def one(column: str, name: str) -> DataFrame:
        found = _in(renters, name, as_of, "last_logon_time").agg(F.count_distinct("id").alias(column))
        return found.withColumn("rk", F.lit("1"))

    frames = [one("DAU", "day"), one("WAU", "week"), one("MAU", "month")]
    return reduce(lambda a, b: a.join(b, "rk"), frames).select("rk", "DAU", "WAU", "MAU")


def hot_cells(orders: DataFrame, day: str, before: str) -> DataFrame:
    from wayfare.operators.spatial import latest_per_cell, with_cell

    def cells(d: str) -> DataFrame:
        placed = with_cell(orders.where(on_day(F.col("create_time"), d)), "open_lat", "open_lng", 7)
        return latest_per_cell(placed, "create_time", "id", ["begin_address_code"]).select(
            "cell", F.col("begin_address_code").alias(f"c{d}"), F.lit(1).alias(f"n{d}")
        )

    both = cells(day).join(cells(before), "cell", "full")
    code = F.coalesce(f"c{day}", f"c{before}").alias("code")
    change = both.groupBy(code).agg(
        F.sum(F.coalesce(f"n{day}", F.lit(0)) - F.coalesce(f"n{before}", F.lit(0))).alias("_new_orders_num")
    )
    today = cells(day).groupBy(F.col(f"c{day}").alias("code")).agg(F.sum(f"n{day}").alias("_day_order_num"))
    return today.join(change, "code", "left").select(F.col("code").alias("_city_code"), "_day_order_num", "_new_orders_num")


PAIRS = {
    "completion_city": {
        "one_pass": lambda s, d: reports.completion_by_city(v.orders(s, d), DAY).drop("rk"),
        "joins": lambda s, d: completion(v.orders(s, d), "city_name", DAY),
    },
    "completion_driver": {
        "one_pass": lambda s, d: reports.completion_by_driver(v.orders(s, d), DAY).drop("rk", "driver_name"),
        "joins": lambda s, d: completion(v.orders(s, d), "driver_id", DAY),
    },
    "driver_registrations": {
        "one_pass": lambda s, d: reports.driver_registrations(v.drivers(s, d), DRIVER_DAY).drop("rk"),
        "joins": lambda s, d: registrations(v.drivers(s, d), DRIVER_DAY),
    },
    "region_orders": {
        "one_pass": lambda s, d: reports.region_orders(v.orders(s, d), DAY).drop("o_begin_address_code"),
        "joins": lambda s, d: region_orders(v.orders(s, d), DAY),
    },
    "region_users": {
        "one_pass": lambda s, d: reports.region_users(v.renters(s, d), RENTER_DAY).drop("_city_code"),
        "joins": lambda s, d: region_users(v.renters(s, d), RENTER_DAY),
    },
    "active_users": {
        "one_pass": lambda s, d: reports.active_users(v.renters(s, d), RENTER_DAY),
        "joins": lambda s, d: active_users(v.renters(s, d), RENTER_DAY),
    },
    "retention": {
        "one_pass": lambda s, d: reports.retention(v.renters(s, d), RETENTION_PAIRS),
        "joins": lambda s, d: retention(v.renters(s, d), RETENTION_PAIRS),
    },
    "hot_cells": {
        "one_pass": lambda s, d: hot.hot_cells(v.orders(s, d), DAY).drop("rk"),
        "joins": lambda s, d: hot_cells(v.orders(s, d), DAY, "1998-07-14"),
    },
}
