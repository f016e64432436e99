"""Grid columns, representative points and district matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import geometry, hexgrid
from wayfare.operators.joins import salted_join
from wayfare.operators.latest import newest_per
from wayfare.operators.pinning import pin

TILE_DEGREES = 0.01


def with_cell(df: DataFrame, lat: str, lng: str, res: int, name: str = "cell") -> DataFrame:
    """Add the cell id; rows without a position have no cell and are left out.

    The fractions get a projection of their own, so that the id is built from
    two columns. The id is never NULL and says so: joins and groupings on it
    then need no NULL test, which would be a second evaluation below.
    """
    qf, rf = hexgrid.axial_fractions(F.col(lat), F.col(lng), res)
    placed = df.where(F.col(lat).isNotNull() & F.col(lng).isNotNull()).withColumns({"_qf": qf, "_rf": rf})
    cell = F.coalesce(hexgrid.pack_cell(F.col("_qf"), F.col("_rf"), res), F.lit(-1).cast("bigint"))
    return placed.withColumn(name, cell).drop("_qf", "_rf")


def latest_per_cell(cells: DataFrame, ts: str, row_id: str, values: list[str]) -> DataFrame:
    return newest_per(cells, ["cell"], [ts, row_id], values)


def cells_with_min_orders(cells: DataFrame, min_orders: int) -> DataFrame:
    """Orders of the cells that hold at least ``min_orders``, with the cell's count.

    A threshold of one keeps every cell, yet the count column is still wanted
    by callers.
    """
    counts = (
        cells.groupBy("cell").agg(F.count(F.lit(1)).alias("total"))
        .where(F.col("total") >= min_orders)
    )
    return cells.join(counts, "cell")


def representatives(orders: DataFrame, res: int = hexgrid.STATION_RES, min_orders: int = 1) -> DataFrame:
    """One order per cell: least longitude, then latitude, then id ("virtual station").

    The order count rides along in the same aggregation, so a higher threshold
    needs neither a second pass nor a join.
    """
    cells = with_cell(orders, "starting_lat", "starting_lng", res)
    first = F.min(F.struct("starting_lng", "starting_lat", "order_id", "city_id"))
    picked = cells.groupBy("cell").agg(first.alias("p"), F.count(F.lit(1)).alias("total"))
    if min_orders > 1:
        picked = picked.where(F.col("total") >= min_orders)
    return picked.select(
        F.col("p.order_id").alias("order_id"),
        F.col("p.city_id").alias("city_id"),
        F.col("p.starting_lng").alias("starting_lng"),
        F.col("p.starting_lat").alias("starting_lat"),
        F.lit(1).alias("rn"),
        "cell",
    )


def district_edges(districts: DataFrame) -> DataFrame:
    """Districts with a usable polygon, as one array of edges each."""
    named = districts.select("citycode", "name", "polygon").where(F.col("polygon").isNotNull())
    edges = geometry.ring_edges(geometry.parse_polygon(F.col("polygon")))
    return pin(named, edges=edges).drop("polygon").where(F.size("edges") > 0)


def district_tiles(districts: DataFrame, tile: float = TILE_DEGREES) -> DataFrame:
    """Square tiles each district touches, with only the edges that matter there.

    Edges come first: each goes to the rows of tiles it meets and names the tiles
    it meets there. Per district and row, those tiles carry the row's edges that a
    ray going east from them can cross or touch; a run of tiles between them
    meets no edge, so one point of it tells whether all are ``whole``, inside the
    district, and need no test per point. The work follows the length of the
    outline and the tiles inside, and is spread over the rows. A district that is
    given twice counts once.
    """
    # a hair of slack on the tile sides, so that rounding of tile * index loses no edge
    slack, side = F.lit(1e-9), F.lit(tile)
    named = pin(district_edges(districts), did=F.xxhash64("citycode", "name", F.to_json("edges")))
    edges = named.select("did", "citycode", "name", F.explode("edges").alias("e")).distinct()
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    rowed = edges.withColumn("ty", F.explode(F.sequence(F.floor((low - slack) / side), F.floor((high + slack) / side))))
    south, north = F.col("ty") * side - slack, (F.col("ty") + 1) * side + slack

    def x_at(y):
        share = (y - F.col("e.y1")) / (F.col("e.y2") - F.col("e.y1"))
        return F.col("e.x1") + share * (F.col("e.x2") - F.col("e.x1"))

    level = high - low <= slack
    a = F.when(level, F.col("e.x1")).otherwise(x_at(F.greatest(low, south)))
    b = F.when(level, F.col("e.x2")).otherwise(x_at(F.least(high, north)))
    met = F.sequence(F.floor((F.least(a, b) - slack) / side), F.floor((F.greatest(a, b) + slack) / side))
    rows = rowed.withColumn("met", met).groupBy("did", "citycode", "name", "ty").agg(
        F.collect_list("e").alias("edges"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("met")))).alias("xs")
    )
    near = rows.select("citycode", "name", "ty", "edges", F.explode("xs").alias("tx")).select(
        "tx", "ty", "citycode", "name", F.lit(False).alias("whole"),
        F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= F.col("tx") * side - slack).alias("edges"),
    )
    between = F.filter(
        F.transform("xs", lambda x, i: F.struct((x + 1).alias("a"), (F.get("xs", i + 1) - 1).alias("b"))),
        lambda g: g["b"].isNotNull() & (g["a"] <= g["b"]),
    )
    gaps = rows.select("citycode", "name", "ty", "edges", F.explode(between).alias("gap"))
    middle = geometry.inside(F.col("edges"), (F.col("gap.a") + 0.5) * side, (F.col("ty") + 0.5) * side)
    whole = gaps.where(middle).select(
        F.explode(F.sequence("gap.a", "gap.b")).alias("tx"), "ty", "citycode", "name", F.lit(True).alias("whole"),
        F.lit(None).cast(near.schema["edges"].dataType).alias("edges"),
    )
    return near.unionByName(whole)


def match_districts(
    points: DataFrame,
    districts: DataFrame,
    lng: str = "starting_lng",
    lat: str = "starting_lat",
    tile: float = TILE_DEGREES,
    salts: int = 1,
) -> DataFrame:
    """Points with the name of every district that contains them; others are dropped.

    An equi-join on the tile, refined by the exact containment test. There is
    no broadcast hint: Catalyst broadcasts the tiles when their size allows and
    shuffles otherwise; ``salts`` then splits the points of a crowded tile.
    """
    tiles = district_tiles(districts, tile).withColumnsRenamed(
        {"name": "district_name", "citycode": "district_citycode"}
    )
    placed = points.withColumn("tx", F.floor(F.col(lng) / F.lit(tile))).withColumn(
        "ty", F.floor(F.col(lat) / F.lit(tile))
    )
    candidates = salted_join(placed, tiles, ["tx", "ty"], [lng, lat], salts)
    contained = F.col("whole") | geometry.inside(F.col("edges"), F.col(lng), F.col(lat))
    return candidates.where(contained).drop("tx", "ty", "edges", "whole")


def centroid(df: DataFrame, keys: list[str], lat: str, lng: str) -> DataFrame:
    """Geographic mean of all points per key, through unit vectors."""
    x, y, z = geometry.unit_vector(F.col(lat), F.col(lng))
    means = df.groupBy(*keys).agg(F.avg(x).alias("x"), F.avg(y).alias("y"), F.avg(z).alias("z"))
    center_lat, center_lng = geometry.mean_direction(F.col("x"), F.col("y"), F.col("z"))
    return means.select(*keys, center_lat.alias("center_lat"), center_lng.alias("center_lng"))

