"""Serving selections over report tables and result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators import tracks
from wayfare.sources.schema import stringify

# Served columns per report, in order.
SERVED = {
    "active_users": ("DAU", "WAU", "MAU"),
    "platform_totals": ("totalOrderNum", "monthOrderNum", "avgOrderNum", "charge_mileage"),
    "completion_driver": (
        "driver_id", "driver_name", "_year_comple_rate", "_quarter_comple_rate", "_month_comple_rate",
        "_week_comple_rate", "_day_comple_rate",
    ),
    "completion_city": (
        "city_name", "_year_comple_rate", "_quarter_comple_rate", "_month_comple_rate",
        "_week_comple_rate", "_day_comple_rate",
    ),
    "hot_cells": ("_city_code", "_day_order_num", "_new_orders_num"),
    "income": ("totalCount", "registerTotalCount", "pay_all"),
    "new_users": ("dayNewUserCount", "weekNewUserCount", "monthNewUserCount"),
    "driver_registrations": (
        "register_city", "_register_year_num", "_register_quarter_num", "_register_month_num",
        "_register_week_num", "_register_day_num",
    ),
    "retention": ("monthStateRate", "weekStateRate", "dayStateRate"),
    "region_users": ("_city_code", "_day_new_user", "DAU"),
    "region_orders": (
        "o_begin_address_code", "monthVehicleCount", "dayVehicleCount", "monthOrderCount",
        "weekOrderCount", "dayOrderCount",
    ),
    "hot_points": ("begin_address_code", "centerPoint", "count"),
}


def serve(report: DataFrame, name: str) -> DataFrame:
    """The columns a report shows, all as text."""
    return stringify(report.select(*SERVED[name]))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def gps_query(rows: DataFrame, start: str = "", end: str = "", city_code: str = "", narrow: bool = False) -> DataFrame:
    """GPS rows by optional time bounds (inclusive) and city; an empty argument is no condition."""
    conditions = []
    if start:
        conditions.append(F.col("time") >= F.lit(start))
    if end:
        conditions.append(F.col("time") <= F.lit(end))
    if city_code:
        conditions.append(F.col("citycode") == F.lit(city_code))
    columns = ["time", "lng", "lat"] if narrow else ["rowkey", "driverid", "orderid", "timestamp", "time", "lng", "lat"]
    return rows.where(_all(conditions)).select(*columns)


def stations_query(stations: DataFrame, city_code: str = "", district: str = "") -> DataFrame:
    conditions = []
    if city_code:
        conditions.append(F.col("city_id") == F.lit(city_code))
    if district:
        conditions.append(F.col("district_name") == F.lit(district))
    return stations.where(_all(conditions)).select("city_id", "district_name", "lng", "lat")


def stations_count(stations: DataFrame, city_code: str) -> DataFrame:
    return (
        stations.where(F.col("city_id") == F.lit(city_code))
        .groupBy("district_name").agg(F.count(F.lit(1)).alias("count"))
    )


def day_overview(points: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Orders and passengers per day; a day known to only one side counts zero on the other."""
    orders = tracks.daily_order_counts(tracks.hourly_order_counts(points))
    passengers = order_lines.groupBy(
        F.to_date(F.substring("departure_time", 1, 10)).alias("day")
    ).agg(F.sum(F.col("passenger_count").try_cast("bigint")).alias("passenger_count"))
    merged = orders.join(passengers, "day", "full")
    return merged.select(
        "day",
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.coalesce("passenger_count", F.lit(0)).alias("passenger_count"),
    )
