"""Grid functions for SQL users, as SQL functions: no Python or JVM code per row."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wayfare.functions.hexgrid import ORIGIN_LAT, ORIGIN_LNG, Grid

RESOLUTIONS = range(16)
_OFFSET, _MASK = 1 << 27, (1 << 28) - 1


def _double(value: float) -> str:
    """A literal that SQL reads as this very double (a plain decimal would not be one)."""
    return f"{value!r}D"


def _per_resolution(pick) -> str:
    cases = " ".join(f"WHEN {r} THEN {_double(pick(Grid(r)))}" for r in RESOLUTIONS)
    return f"CASE res {cases} END"


def _cell_id_sql() -> str:
    any_grid = Grid(0)
    x = f"(lng - {_double(ORIGIN_LNG)}) * {_double(any_grid.metres_per_lng)}"
    y = f"(lat - {_double(ORIGIN_LAT)}) * {_double(any_grid.metres_per_lat)}"
    xq, yq, yr = (_per_resolution(lambda g, i=i: g.factors[i]) for i in range(3))
    fractions = f"SELECT {x} * ({xq}) - {y} * ({yq}) AS qf, {y} * ({yr}) AS rf"
    rounded = (
        "SELECT floor(qf + 0.5D) AS q, floor(rf + 0.5D) AS r, "
        f"qf - floor(qf + 0.5D) AS dq, rf - floor(rf + 0.5D) AS dr FROM ({fractions})"
    )
    cell_q = "q + CASE WHEN abs(dq) >= abs(dr) THEN floor(dq + dr * 0.5D + 0.5D) ELSE 0 END"
    cell_r = "r + CASE WHEN abs(dq) >= abs(dr) THEN 0 ELSE floor(dr + dq * 0.5D + 0.5D) END"
    return (
        f"SELECT shiftleft(cast(res AS BIGINT), 56) + ({cell_q} + {_OFFSET}) * {1 << 28} + ({cell_r} + {_OFFSET}) "
        f"FROM ({rounded})"
    )


def _center_sql() -> str:
    grid = Grid(0)
    edge = "CASE shiftright(cell, 56) " + " ".join(
        f"WHEN {r} THEN {_double(Grid(r).edge)}" for r in RESOLUTIONS
    ) + " END"
    q = f"((shiftright(cell, 28) & {_MASK}) - {_OFFSET})"
    r = f"((cell & {_MASK}) - {_OFFSET})"
    lng = f"{_double(ORIGIN_LNG)} + ({q} + {r} * 0.5D) * ({edge}) * {_double(3 ** 0.5 / grid.metres_per_lng)}"
    lat = f"{_double(ORIGIN_LAT)} + {r} * ({edge}) * {_double(1.5 / grid.metres_per_lat)}"
    return f"concat_ws(',', cast(round({lat}, 6) AS STRING), cast(round({lng}, 6) AS STRING))"


def register(spark: SparkSession) -> None:
    """``location_to_cell(lat, lng, res)`` and ``cell_to_coordinate(cell)`` for this session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION location_to_cell(lat DOUBLE, lng DOUBLE, res INT) "
        f"RETURNS BIGINT RETURN {_cell_id_sql()}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION cell_to_coordinate(cell BIGINT) "
        f"RETURNS STRING RETURN {_center_sql()}"
    )
