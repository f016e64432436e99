"""Hexagon grid written as column arithmetic.

A pointy-top hexagon grid on a plane tangent at a fixed origin. Cell edges have
the usual sizes of an aperture-7 hexagon hierarchy (resolution 7 has an edge of
about 1.22 km, resolution 12 about 9.4 m). Ids pack resolution and axial
coordinates in one bigint, so the cell can be read back from the id alone.
All of it stays inside whole-stage codegen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371007.1809
EDGE_RES0_M = 1107712.591
ORIGIN_LNG = 110.0
ORIGIN_LAT = 20.0
STATION_RES = 12
HOT_RES = 7
HOT_RADIUS_M = 1200

_OFFSET = 1 << 27
_MASK = (1 << 28) - 1


@dataclass(frozen=True)
class Grid:
    """Scale factors of one resolution; plain floats, so they fold into the plan."""

    res: int
    lng0: float = ORIGIN_LNG
    lat0: float = ORIGIN_LAT

    @property
    def edge(self) -> float:
        return EDGE_RES0_M / math.sqrt(7.0) ** self.res

    @property
    def metres_per_lat(self) -> float:
        return EARTH_RADIUS_M * math.pi / 180.0

    @property
    def metres_per_lng(self) -> float:
        return self.metres_per_lat * math.cos(math.radians(self.lat0))

    @property
    def factors(self) -> tuple[float, float, float]:
        """x to q, y to q, y to r."""
        return math.sqrt(3.0) / 3.0 / self.edge, 1.0 / 3.0 / self.edge, 2.0 / 3.0 / self.edge

    @property
    def corners(self) -> list[tuple[float, float]]:
        """Corner offsets in degrees, counter-clockwise from the lower right."""
        turns = [math.radians(60.0 * i - 30.0) for i in range(6)]
        return [
            (self.edge * math.cos(a) / self.metres_per_lng, self.edge * math.sin(a) / self.metres_per_lat)
            for a in turns
        ]


def _nearest(value: Column) -> Column:
    return F.floor(value + F.lit(0.5))


def axial_fractions(lat: Column, lng: Column, res: int) -> tuple[Column, Column]:
    """Position in units of the two grid axes."""
    grid = Grid(res)
    xq, yq, yr = grid.factors
    x = (lng.cast("double") - F.lit(grid.lng0)) * F.lit(grid.metres_per_lng)
    y = (lat.cast("double") - F.lit(grid.lat0)) * F.lit(grid.metres_per_lat)
    return x * F.lit(xq) - y * F.lit(yq), y * F.lit(yr)


def pack_cell(qf: Column, rf: Column, res: int) -> Column:
    """Id of the cell nearest to a fractional position.

    Both axes are rounded, then the axis with the larger error takes the
    correction by half of the other's error.
    """
    q, r = _nearest(qf), _nearest(rf)
    dq, dr = qf - q, rf - r
    q_leads = F.abs(dq) >= F.abs(dr)
    cell_q = q + F.when(q_leads, _nearest(dq + dr * F.lit(0.5))).otherwise(F.lit(0))
    cell_r = r + F.when(q_leads, F.lit(0)).otherwise(_nearest(dr + dq * F.lit(0.5)))
    return F.lit(res << 56) + (cell_q + F.lit(_OFFSET)) * F.lit(1 << 28) + (cell_r + F.lit(_OFFSET))


def cell_id(lat: Column, lng: Column, res: int) -> Column:
    """The cell as one expression; ``with_cell`` computes it in steps."""
    return pack_cell(*axial_fractions(lat, lng, res), res)


def cell_resolution(cell: Column) -> Column:
    return F.shiftright(cell, 56).cast("int")


def cell_axial(cell: Column) -> tuple[Column, Column]:
    q = F.shiftright(cell, 28).bitwiseAND(F.lit(_MASK)) - F.lit(_OFFSET)
    r = cell.bitwiseAND(F.lit(_MASK)) - F.lit(_OFFSET)
    return q, r


def cell_center_lng(cell: Column, res: int) -> Column:
    grid = Grid(res)
    q, r = cell_axial(cell)
    step = grid.edge * math.sqrt(3.0) / grid.metres_per_lng
    return F.lit(grid.lng0) + (q + r * F.lit(0.5)) * F.lit(step)


def cell_center_lat(cell: Column, res: int) -> Column:
    grid = Grid(res)
    _, r = cell_axial(cell)
    return F.lit(grid.lat0) + r * F.lit(grid.edge * 1.5 / grid.metres_per_lat)


def _degrees_text(value: Column) -> Column:
    return F.round(value, 6).cast("string")


def cell_lat_lng_text(cell: Column, res: int) -> Column:
    """Cell centre as ``lat,lng``."""
    return F.concat_ws(
        ",", _degrees_text(cell_center_lat(cell, res)), _degrees_text(cell_center_lng(cell, res))
    )


def cell_lng_lat_text(cell: Column, res: int) -> Column:
    """Cell centre as ``lng,lat``."""
    return F.concat_ws(
        ",", _degrees_text(cell_center_lng(cell, res)), _degrees_text(cell_center_lat(cell, res))
    )


def cell_boundary(cell: Column, res: int) -> Column:
    """Six corner points as ``array<struct<lng,lat>>``."""
    lng, lat = cell_center_lng(cell, res), cell_center_lat(cell, res)
    return F.array(
        *[F.struct((lng + F.lit(dx)).alias("lng"), (lat + F.lit(dy)).alias("lat")) for dx, dy in Grid(res).corners]
    )


def points_text(points: Column) -> Column:
    """``lng,lat;lng,lat;…`` with six decimals."""
    return F.array_join(
        F.transform(points, lambda p: F.concat_ws(",", _degrees_text(p["lng"]), _degrees_text(p["lat"]))), ";"
    )
