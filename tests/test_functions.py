"""Scalar expressions against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayfare.functions import geometry, hexgrid, keys, text, times
from wayfare.operators import spatial
from wayfare.sources import districts as district_source
from wayfare.sources import readers, schema


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).collect()[0][0]


def plain_hash(s: str) -> int:
    h = 0
    for ch in s:
        h = (h * 31 + ord(ch)) & 0xFFFFFFFF
    return h


def test_row_keys(spark):
    assert one(spark, "1_20200120180752", lambda v: keys.salted_key(v, 8)) == "0004a97f493208b0"
    for s in ("", "a", "zzzzzzzzzzzzzz", "京A12345"):
        want = f"{(plain_hash(s) & 0x7FFFFFFF) % 8:04d}" + hashlib.md5(s.encode()).hexdigest()[:12]
        assert one(spark, s, keys.salted_key) == want
        key = one(spark, s, keys.hash_prefixed_key)
        assert bytes(key) == (plain_hash(s) & 0x7FFF).to_bytes(2, "big") + s.encode()
    digest = hashlib.md5(b"a_b").hexdigest()
    for length, kept in ((1, 8), (8, 8), (20, 20), (32, 32), (99, 32)):
        assert one(spark, "a", lambda v: keys.md5_prefixed_key("_", length, v, F.lit("b"))) == f"{digest[:kept]}_a_b"


@pytest.mark.parametrize("value,want", [
    ("2019-07-15 08:09:10", "20190715080910"), ("2019-07-15", None), ("", None), ("  ", None), ("2019-07-15 ", None), (None, None),
])
def test_compact_time(spark, value, want):
    assert one(spark, value, times.compact_time) == want


def test_times(spark):
    assert one(spark, "1568025609176", times.any_time_text) == "2019-09-09 10:40:09"
    assert one(spark, "2019-09-09T10:40:09.176Z", times.any_time_text) == "2019-09-09 10:40:09"
    assert one(spark, "soon", times.any_time_text) is None
    assert one(spark, 1568025609, times.epoch_hour, "bigint") == 10
    assert one(spark, "201903010030", times.days_before) == "201902140030"
    assert one(spark, "2019-10-05 00:00:00", lambda v: times.month_suffix(v.cast("timestamp"))) == "201910"


def test_order_keys_and_json(spark):
    bare = "a" * 32
    assert one(spark, bare, text.order_key) == f"075_{bare}"
    assert one(spark, f"075_{bare}", text.order_key) == f"075_{bare}"
    assert one(spark, "short", text.order_key) == "short"
    assert one(spark, f"075_{bare}", text.bare_order_id) == bare
    assert one(spark, '{"a":null,"b":3}', lambda v: F.concat_ws("|", text.json_field(v, "a"), text.json_field(v, "b"), text.json_field(v, "c", "d"))) == "|3|d"


@pytest.mark.parametrize("page, want", [
    ("<p>a</p>< SCRIPT x>bad()</ script >b", "<p>a</p>b"),
    ("a<iframe src=x>y\n</iframe>b<style>s\n</style>c", "abc"),
    ("<p onclick= go(1) class=c>a</p>", "<p class=c>a</p>"),
    ("<p onClick='go(\"x\")'>a</p><img\nonerror=\"b c\" src=d>", "<p>a</p><img src=d>"),
    ("<link rel=a /><link rel=b><linked>k</linked>", "<linked>k</linked>"),
    ("<a href=JavaScript:f()>z</a><a HREF = ' javascript:g()' id=i>y</a>", "<a>z</a><a id=i>y</a>"),
    ("<meta content='on=1' name=contents> version=2 <b>on time</b>", "<meta content='on=1' name=contents> version=2 <b>on time</b>"),
    ("<object data=x><embed src=a></object><frameset><frame></frameset><base target=_top>t", "t"),
    ("", ""),
])
def test_unsafe_markup_is_removed(spark, page, want):
    assert one(spark, page, text.strip_unsafe_html) == want


# ---- grid ----

def cube_cell(lat: float, lng: float, res: int) -> tuple[int, int]:
    g = hexgrid.Grid(res)
    xq, yq, yr = g.factors
    x, y = (lng - g.lng0) * g.metres_per_lng, (lat - g.lat0) * g.metres_per_lat
    qf, rf = x * xq - y * yq, y * yr
    sf = -qf - rf
    q, r, s = (math.floor(v + 0.5) for v in (qf, rf, sf))
    dq, dr, ds = abs(q - qf), abs(r - rf), abs(s - sf)
    if dq > dr and dq > ds:
        q = -r - s
    elif dr > ds:
        r = -q - s
    return q, r


@pytest.mark.parametrize("res", [5, 7, 9, 12])
def test_cells_by_brute_force(spark, res):
    rng = random.Random(res)
    spots = [(i, 20 + rng.uniform(-1, 1), 110 + rng.uniform(-1, 1)) for i in range(2000)]
    df = spark.createDataFrame(spots, "i int, lat double, lng double")
    cells = spatial.with_cell(df, "lat", "lng", res)
    got = cells.select(
        "i", *hexgrid.cell_axial(F.col("cell")), hexgrid.cell_center_lat(F.col("cell"), res),
        hexgrid.cell_center_lng(F.col("cell"), res), hexgrid.cell_resolution(F.col("cell")),
        hexgrid.cell_id(F.col("lat"), F.col("lng"), res) == F.col("cell"),
    ).collect()
    g = hexgrid.Grid(res)
    for i, q, r, clat, clng, level, same in got:
        _, lat, lng = spots[i]
        assert (q, r) == cube_cell(lat, lng, res) and level == res and same
        away = math.hypot((lng - clng) * g.metres_per_lng, (lat - clat) * g.metres_per_lat)
        assert away <= g.edge * 1.000001


def test_cell_sizes():
    assert abs(hexgrid.Grid(7).edge - 1220.6) < 0.1 and abs(hexgrid.Grid(12).edge - 9.415) < 0.01


def test_rows_without_position_have_no_cell(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (20.0, 110.0)], "lat double, lng double")
    assert spatial.with_cell(df, "lat", "lng", 7).count() == 1


def test_representative_is_numeric_order(spark):
    df = spark.createDataFrame(
        [("b", "125", 110.00001, 20.0), ("a", "125", 110.00001, 20.0), ("c", "125", 110.00002, 19.99999)],
        schema.T.StructType.fromDDL("order_id string, city_id string, starting_lng double, starting_lat double"),
    )
    got = spatial.representatives(df, 12)
    assert [r["order_id"] for r in got.collect()] == ["a"]
    assert spatial.representatives(df, 12, min_orders=4).count() == 0
    assert spatial.representatives(df, 12, min_orders=3).count() == 1


# ---- polygons ----

SQUARE = "0,0;4,0;4,4;0,4"


@pytest.mark.parametrize("polygon,x,y,want", [
    (SQUARE, 2.0, 2.0, True), (SQUARE, 0.0, 2.0, False), (SQUARE, 4.0, 4.0, False), (SQUARE, 5.0, 2.0, False),
    (SQUARE, 2.0, 0.0, False), (SQUARE + "|1,1;3,1;3,3;1,3", 2.0, 2.0, False), (SQUARE + "|1,1;3,1;3,3;1,3", 0.5, 2.0, True),
    (SQUARE + "|1,1;3,1;3,3;1,3", 1.0, 2.0, False), (SQUARE + "|10,10;12,10;11,12", 11.0, 11.0, True),
    (SQUARE + ";0,0", 2.0, 2.0, True), ("", 1.0, 1.0, None),
])
def test_match_one_point(spark, polygon, x, y, want):
    areas = spark.createDataFrame([("125", "d", polygon)], "citycode string, name string, polygon string")
    points = spark.createDataFrame([(x, y)], "starting_lng double, starting_lat double")
    for tile in (0.3, 1.0, 50.0):
        assert spatial.match_districts(points, areas, tile=tile).count() == (1 if want else 0)


def even_odd(rings, x, y) -> bool:
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


@pytest.mark.parametrize("salts", [1, 5])
def test_match_by_brute_force(spark, salts):
    rng = random.Random(7)
    shapes = []
    for k in range(12):
        cx, cy, n = rng.uniform(0, 10), rng.uniform(0, 10), rng.randint(3, 40)
        ring = [(cx + rng.uniform(0.5, 3) * math.cos(6.283 * i / n), cy + rng.uniform(0.5, 3) * math.sin(6.283 * i / n)) for i in range(n)]
        inner = [(cx + 0.2 * math.cos(6.283 * i / 5), cy + 0.2 * math.sin(6.283 * i / 5)) for i in range(5)]
        shapes.append([ring, inner] if k % 2 else [ring])
    texts = ["|".join(";".join(f"{x!r},{y!r}" for x, y in ring) for ring in s) for s in shapes]
    areas = spark.createDataFrame([("c", str(k), t) for k, t in enumerate(texts)], "citycode string, name string, polygon string")
    spots = [(i, rng.uniform(-1, 11), rng.uniform(-1, 11)) for i in range(1500)]
    points = spark.createDataFrame(spots, "i int, starting_lng double, starting_lat double")
    got = rows(spatial.match_districts(points, areas, tile=0.25, salts=salts).select("i", "district_name"))
    want = sorted(((i, str(k)) for i, x, y in spots for k, s in enumerate(shapes) if even_odd(s, x, y)), key=repr)
    assert got == want and len(got) > 500


def test_tiles_away_from_edges_need_no_point_test(spark):
    areas = spark.createDataFrame([("c", "d", "0,0;10,0;10,10;0,10")], "citycode string, name string, polygon string")
    tiles = spatial.district_tiles(areas, 1.0)
    assert tiles.where("whole").count() == 64
    assert tiles.where("not whole and edges is null").count() == 0


def test_centers(spark):
    df = spark.createDataFrame([("k", 0.0, 10.0), ("k", 0.0, 20.0)], "k string, lat double, lng double")
    got = spatial.centroid(df, ["k"], "lat", "lng").collect()[0]
    assert abs(got["center_lat"]) < 1e-9 and abs(got["center_lng"] - 15) < 1e-9
    ring = F.array(*[F.struct(F.lit(x).alias("lng"), F.lit(y).alias("lat")) for x, y in ((10.0, 0.0), (20.0, 0.0))])
    mid = df.select(geometry.points_center(ring)["lng"]).first()[0]
    assert abs(mid - 15) < 1e-9


# ---- sources ----

def test_district_tree(spark):
    tree = (
        '{"districts":[{"name":"H","level":"city","citycode":"0898","districts":['
        '{"name":"A","level":"district","citycode":"0898","polyline":"0,0;1,0;1,1"},'
        '{"name":"B","level":"district","citycode":"0898"},{"name":"S","level":"street","citycode":"0898","polyline":"x"}]},'
        '{"name":"T","level":"district","citycode":"075","polyline":"5,5;6,5;6,6"},{"name":"P","level":"province"}]}'
    )
    docs = spark.createDataFrame([(tree,), ("not json",)], "value string")
    assert rows(district_source.flatten_tree(docs)) == [("075", "T", "5,5;6,5;6,6"), ("0898", "A", "0,0;1,0;1,1")]
    assert rows(district_source.flatten_tree(docs, "075")) == [("075", "T", "5,5;6,5;6,6")]


def test_geojson_file(spark, tmp_path):
    doc = (
        '﻿{"type": "FeatureCollection", "features": [{"type":"Feature","properties":{"name":"L"},"geometry":'
        '{"type":"MultiPolygon","coordinates":[[[[0,0],[4,0],[4,4],[0,4],[0,0]]],[[[10.5,10],[12,10],[11,12],[10.5,10]]]]}}]}'
    )
    (tmp_path / "d.json").write_text(doc, encoding="utf-8")
    flat = district_source.flatten_geojson(district_source.read_documents(spark, str(tmp_path / "d.json")))
    assert flat.collect()[0]["polygon"].count("|") == 1
    points = spark.createDataFrame([(1.0, 1.0), (11.0, 10.5), (8.0, 8.0)], "starting_lng double, starting_lat double")
    assert spatial.match_districts(points, flat, tile=1.0).count() == 2


def test_family_columns_from_map_and_struct(spark):
    df = spark.sql("select map('a', '1', 'b', '2') as MM, named_struct('c', cast(null as string)) as f1")
    got = readers.select_family(df, "MM:b , f1:c,a , MM:zz", "x string, y string, z string, w string").collect()[0]
    assert tuple(got) == ("2", "", "1", "")
    with pytest.raises(ValueError):
        readers.select_family(df, "MM:a", "x string, y string")


def test_typed_layer_reads_files(spark, tmp_path):
    raw = spark.createDataFrame([("1", "2019-01-01 00:00:00", "", "", "A"), ("2", "", "460100", "x", "")], schema.raw_ddl("renter"))
    for fmt in ("parquet", "orc", "json", "csv"):
        path = str(tmp_path / fmt)
        raw.write.format(fmt).save(path)
        got = readers.read_entity(spark, path, "renter", fmt).orderBy("id").collect()
        assert got[0]["last_login_city"] is None and got[1]["create_time"] is None and got[1]["last_logon_time"] is None
    assert readers.scan_key_range(raw, "id", "2").count() == 1 and readers.scan_key_range(raw, "id", "", "2").count() == 1
    assert schema.raw_schema(None).fieldNames() == ["id"]


def test_history_reads_only_the_months_asked_for(spark, data, tmp_path):
    from wayfare.operators.periods import filter_period
    from wayfare.sources import sinks

    rides = spark.read.parquet(f"{data}/lineitem.parquet")
    path = str(tmp_path / "history")
    sinks.write_history(rides, path, "l_shipdate")
    assert readers.read_history(spark, path).count() == rides.count()
    july = filter_period(readers.read_history(spark, path, "1998-07-01", "1998-07-31"), "l_shipdate", "month", "1998-07-15")
    plan = july.select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "(month#" in plan.split("PartitionFilters")[1] and "GreaterThanOrEqual(l_shipdate" in plan
    assert rows(july.select("l_orderkey")) == rows(filter_period(rides, "l_shipdate", "month", "1998-07-15").select("l_orderkey"))


def test_sizing():
    from wayfare.session import sizing_conf

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sizing_conf(1)[key] == "200" and sizing_conf(1 << 40)[key] == "4096" and sizing_conf(100 << 40)[key] == "409600"
    assert sizing_conf(100 << 40, 100_000)[key] == "100000"
