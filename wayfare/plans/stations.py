"""Virtual stations and their districts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import hexgrid
from wayfare.operators.spatial import match_districts, representatives


def virtual_stations(orders: DataFrame, res: int = hexgrid.STATION_RES, min_orders: int = 1) -> DataFrame:
    return representatives(orders, res, min_orders).drop("cell")


def stations_by_district(
    orders: DataFrame, districts: DataFrame, res: int = hexgrid.STATION_RES, min_orders: int = 1
) -> DataFrame:
    """Stations with each district that contains them.

    The stations of a tile are bounded by its cells, so no salting is needed.
    """
    placed = match_districts(virtual_stations(orders, res, min_orders), districts)
    return placed.select(
        "order_id", "city_id", F.col("starting_lng").alias("lng"), F.col("starting_lat").alias("lat"),
        F.col("rn").alias("count"), "district_name",
    )


def station_counts(stations: DataFrame) -> DataFrame:
    return stations.groupBy("district_name").agg(F.count(F.lit(1)).alias("count"))
