"""Polygon text, even-odd containment and spherical means as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_polygon(text: Column) -> Column:
    """``lng,lat;lng,lat|…`` to ``array<ring>``, a ring being ``array<struct<lng,lat>>``.

    Parts are separated by ``|``. Rings are combined even-odd, so a part inside
    another part is a hole.
    """

    def vertex(point: Column) -> Column:
        xy = F.split(point, ",")
        return F.struct(
            F.trim(F.get(xy, F.lit(0))).try_cast("double").alias("lng"),
            F.trim(F.get(xy, F.lit(1))).try_cast("double").alias("lat"),
        )

    parts = F.filter(F.split(text, r"\|"), lambda part: F.trim(part) != F.lit(""))
    return F.transform(parts, lambda part: F.transform(F.split(part, ";"), vertex))


def ring_edges(rings: Column) -> Column:
    """All edges of all rings as ``array<struct<x1,y1,x2,y2>>``; open rings are closed."""

    def edges_of(ring: Column) -> Column:
        last = F.size(ring) - 1
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                F.get(ring, i)["lng"].alias("x1"),
                F.get(ring, i)["lat"].alias("y1"),
                F.get(ring, F.when(i == last, F.lit(0)).otherwise(i + 1))["lng"].alias("x2"),
                F.get(ring, F.when(i == last, F.lit(0)).otherwise(i + 1))["lat"].alias("y2"),
            ),
        )

    return F.flatten(F.transform(rings, edges_of))


def _turn(e: Column, x: Column, y: Column) -> Column:
    """Sign tells the side of the edge; zero is on its line. Free of division."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def _crosses(e: Column, x: Column, y: Column) -> Column:
    spans = (e["y1"] > y) != (e["y2"] > y)
    return spans & ((e["y2"] > e["y1"]) == (_turn(e, x, y) > 0.0))


def _touches(e: Column, x: Column, y: Column) -> Column:
    in_box = (
        (x >= F.least(e["x1"], e["x2"]))
        & (x <= F.greatest(e["x1"], e["x2"]))
        & (y >= F.least(e["y1"], e["y2"]))
        & (y <= F.greatest(e["y1"], e["y2"]))
    )
    return in_box & (_turn(e, x, y) == 0.0)


def meets_box(e: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether the line of an edge has corners of the box on both sides (or on it)."""
    turns = [_turn(e, x, y) for x in (west, east) for y in (south, north)]
    return (F.least(*turns) <= 0.0) & (F.greatest(*turns) >= 0.0)


def inside(edges: Column, lng: Column, lat: Column) -> Column:
    """Strictly inside by the even-odd rule; a point on the boundary is outside."""
    odd = F.aggregate(edges, F.lit(False), lambda acc, e: acc != _crosses(e, lng, lat))
    return odd & ~F.exists(edges, lambda e: _touches(e, lng, lat))


def unit_vector(lat: Column, lng: Column) -> tuple[Column, Column, Column]:
    la, lo = F.radians(lat), F.radians(lng)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def mean_direction(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Latitude and longitude in degrees of a mean vector."""
    lat = F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))
    return lat, F.degrees(F.atan2(y, x))


def points_center(points: Column) -> Column:
    """Geographic mean of an ``array<struct<lng,lat>>`` as ``struct<lng,lat>``."""
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))

    def add(acc: Column, p: Column) -> Column:
        x, y, z = unit_vector(p["lat"], p["lng"])
        return F.struct((acc["x"] + x).alias("x"), (acc["y"] + y).alias("y"), (acc["z"] + z).alias("z"))

    def finish(acc: Column) -> Column:
        lat, lng = mean_direction(acc["x"], acc["y"], acc["z"])
        return F.struct(lng.alias("lng"), lat.alias("lat"))

    return F.aggregate(points, zero, add, finish)
