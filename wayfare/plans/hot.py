"""Hot cells: day-over-day change per street code, and hot points since a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import hexgrid
from wayfare.operators.periods import as_date, filter_since, on_day
from wayfare.operators.spatial import latest_per_cell, with_cell


def cell_days(orders: DataFrame, day: str | dt.date, res: int = hexgrid.HOT_RES) -> DataFrame:
    """Cells of a day and of the day before, side by side, one row per cell.

    The newest order of a cell names its street. Equal to a full outer join of
    the two days on the cell, done in one aggregation.
    """
    day = as_date(day)
    today = on_day(F.col("create_time"), day)
    before = on_day(F.col("create_time"), day - dt.timedelta(days=1))

    def street(when: Column) -> Column:
        return F.max(F.when(when, F.struct("create_time", "id", "begin_address_code")))

    cells = with_cell(orders.where(today | before), "open_lat", "open_lng", res)
    sides = cells.groupBy("cell").agg(street(today).alias("t"), street(before).alias("y"))
    return sides.select(
        "cell",
        F.col("t").isNotNull().alias("is_today"),
        F.col("y").isNotNull().alias("is_before"),
        F.when(F.col("t").isNotNull(), F.col("t.begin_address_code"))
        .otherwise(F.col("y.begin_address_code")).alias("city_code"),
    )


def hot_change(orders: DataFrame, day: str | dt.date, res: int = hexgrid.HOT_RES) -> DataFrame:
    """Full cell list with its change: +1 new, 0 in both days, -1 gone."""
    days = cell_days(orders, day, res)
    change = F.col("is_today").cast("int") - F.col("is_before").cast("int")
    return days.select(
        "city_code",
        hexgrid.cell_lat_lng_text(F.col("cell"), res).alias("coordinate"),
        "cell",
        F.lit(hexgrid.HOT_RADIUS_M).alias("radius"),
        change.alias("count"),
    )


def hot_cells(orders: DataFrame, day: str | dt.date, res: int = hexgrid.HOT_RES) -> DataFrame:
    """Per street code: cells today and net change against the day before."""
    days = cell_days(orders, day, res)
    change = F.col("is_today").cast("int") - F.col("is_before").cast("int")
    streets = days.groupBy("city_code").agg(
        F.count_if("is_today").alias("_day_order_num"), F.sum(change).alias("_new_orders_num")
    )
    return streets.where(F.col("_day_order_num") > 0).select(
        F.col("city_code").alias("rk"), F.col("city_code").alias("_city_code"), "_day_order_num", "_new_orders_num"
    )


def hot_detail(orders: DataFrame, res: int = hexgrid.HOT_RES) -> DataFrame:
    """Cells with the number of cells of their street: the detail list, one row per item.

    The list stays long rather than an array per street, which would put a
    whole street into one value.
    """
    cells = latest_per_cell(
        with_cell(orders, "open_lat", "open_lng", res), "create_time", "id", ["begin_address_code"]
    )
    items = cells.where(F.col("begin_address_code").isNotNull()).select(
        F.col("begin_address_code").alias("city_code"),
        hexgrid.cell_lat_lng_text(F.col("cell"), res).alias("coordinate"),
        F.lit(hexgrid.HOT_RADIUS_M).alias("radius"),
        F.lit(1).alias("count"),
    )
    totals = items.groupBy("city_code").agg(F.sum("count").alias("city_num"))
    return items.join(totals, "city_code").select(
        "city_code", "city_num", "coordinate", "radius", "count"
    )


def hot_points(orders: DataFrame, since: str | dt.date, res: int = hexgrid.HOT_RES) -> DataFrame:
    """Cells with an order since a date, named by their newest order."""
    cells = with_cell(filter_since(orders, "create_time", since), "open_lat", "open_lng", res)
    newest = latest_per_cell(cells, "create_time", "id", ["begin_address_code"])
    return newest.select(
        F.col("cell").alias("rk"),
        "begin_address_code",
        hexgrid.cell_lng_lat_text(F.col("cell"), res).alias("centerPoint"),
        F.lit(1).alias("count"),
    )
