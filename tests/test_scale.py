"""Skewed keys give whole results; plans keep the shape they were designed for."""

from __future__ import annotations

import ast
import pathlib
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayfare.catalog import views as v
from wayfare.catalog.queries import QUERIES
from wayfare.functions import geometry
from wayfare.operators import joins, spatial, tracks
from wayfare.operators.latest import newest_per


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning", plan))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key."""
    return spark.range(6000).selectExpr("if(id % 3 = 0, 0, id % 400) as k", "id")


def scans(df, name: str) -> int:
    """How often the plan that ran reads a table."""
    df.write.format("noop").mode("overwrite").save()
    return plan_of(df).count(f"{name}.parquet")


@pytest.mark.parametrize("name, table", [("join_self_cell", "lineitem"), ("join_track_trip", "events"), ("track_history", "events"), ("join_hot_split", "lineitem"), ("agg_collect_detail", "lineitem")])
def test_joins_read_their_facts_twice_at_most(spark, data, name, table):
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            assert scans(QUERIES[name](spark, data), table) <= 2
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_activity_needs_no_sort(spark, data):
    assert "SortAggregate" not in plan_of(QUERIES["active_orders"](spark, data))


def test_one_track_filters_both_sides(spark, data):
    plan = plan_of(QUERIES["track_history_order"](spark, data))
    assert plan.count("= 0_2024-01-01") >= 2


def test_salted_join_is_the_inner_join(spark, skewed):
    lookup = spark.range(300).selectExpr("id as k", "explode(array(1, 2)) as w")
    for salts in (1, 7):
        assert rows(joins.salted_join(skewed, lookup, ["k"], ["id"], salts)) == rows(skewed.join(lookup, ["k"]))


def test_salted_tiles_without_broadcast(spark, data):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        args = v.station_orders(spark, data), v.districts(spark, data)
        shuffled = rows(spatial.match_districts(*args, salts=4).select("order_id", "district_name"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled == rows(spatial.match_districts(*args).select("order_id", "district_name")) and shuffled


def test_newest_per_merges_before_the_shuffle(spark, skewed):
    plan = plan_of(newest_per(skewed, ["k"], ["id"], ["id"]))
    assert "partial_max" in plan and "Window" not in plan and exchanges(plan) == 1


ONE_SHUFFLE = ["report_completion_city", "trip_state", "active_orders", "win_latest_per_cell", "virtual_stations", "last_position"]
TWO_SHUFFLES = ["report_completion_driver", "report_driver_registrations", "report_region_orders", "report_hot_cells", "hourly_order_count"]


@pytest.mark.parametrize("name,limit", [(n, 1) for n in ONE_SHUFFLE] + [(n, 2) for n in TWO_SHUFFLES])
def test_shuffles_of_a_report(spark, data, name, limit):
    views_own = {"report_driver_registrations": 1}
    plan = plan_of(QUERIES[name](spark, data))
    assert exchanges(plan) <= limit + views_own.get(name, 0), plan
    assert "Window" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("lineitem.parquet") <= 1 and plan.count("events.parquet") <= 1


STREAMING = {n for n in QUERIES if n.startswith("stream_")} | {"report_write", "report_upsert", "write_stations", "batch_run_all", "batch_upsert"}


#: Queries over a data source that is written in Python; what they do with its rows is not.
PYTHON_SOURCES = {"scan_key_range_source"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, data, name):
    plan = plan_of(QUERIES[name](spark, data))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan
    if name in PYTHON_SOURCES:
        plan = plan.replace("(Python)", "")
    assert "Python" not in plan and "Pandas" not in plan


def test_cell_counts_keep_hot_cells(spark):
    spots = spark.range(900).selectExpr("id", "if(id % 3 = 0, 20.0D, 20.0D + id / 90.0D) as lat", "110.0D as lng")
    cells = spatial.with_cell(spots, "lat", "lng", 9)
    got = spatial.cells_with_min_orders(cells, 2).select("id", "cell", "total")
    counts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("total")).where("total >= 2")
    assert rows(got) == rows(cells.join(counts, "cell").select("id", "cell", "total"))
    assert got.agg(F.max("total")).first()[0] >= 300


def test_track_of_one_huge_order(spark):
    points = spark.range(3000).selectExpr(
        "'d' as driver_id", "if(id % 3 = 0, 'hot', concat('o', id % 50)) as order_id", "timestamp_seconds(id) as ts",
        "1.0D as lng", "2.0D as lat", "false as is_end",
    )
    assert tracks.track_of_trips(points, tracks.trip_state(points)).count() == 3000


ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_library_never_collects_or_pins_to_one_machine():
    for path in (ROOT / "wayfare").rglob("*.py"):
        if "llm" in path.parts:  # the optional package answers for itself
            continue
        tree = ast.parse(path.read_text())
        called = {n.func.attr for n in ast.walk(tree) if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute)}
        assert not called & {"collect", "toPandas", "localCheckpoint", "crossJoin", "rdd"}, path


def test_a_large_district_is_tiled_by_many_tasks(spark):
    """Two degrees across, 2000 edges: the work follows the outline, not area times edges."""
    ring = spark.range(2001).selectExpr(
        "id", "concat(111.0D + cos(radians(id % 2000 * 0.18D)), ',', 21.0D + sin(radians(id % 2000 * 0.18D))) as p"
    ).agg(F.expr("array_join(transform(array_sort(collect_list(struct(id, p))), x -> x.p), ';')").alias("polygon"))
    district = ring.selectExpr("'1' as citycode", "'round' as name", "polygon")
    start = time.perf_counter()
    tiles = spatial.district_tiles(district)
    counted = tiles.groupBy("whole").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("edges")).alias("edges")).collect()
    seconds = time.perf_counter() - start
    by = {r["whole"]: r for r in counted}
    assert abs(by[True]["n"] - 31_416) < 900 and 600 < by[False]["n"] < 1800 and by[False]["edges"] < 120
    assert seconds < 30
    spots = spark.range(4000).selectExpr("id", "110.0D + (id * 7919 % 4001) / 2000D as starting_lng", "20.0D + (id * 104729 % 3989) / 1994D as starting_lat")
    inside = spatial.match_districts(spots, district).select("id")
    edges = spatial.district_edges(district).select("edges")
    brute = spots.join(F.broadcast(edges), F.lit(True)).where(geometry.inside(F.col("edges"), F.col("starting_lng"), F.col("starting_lat")))
    assert rows(inside) == rows(brute.select("id")) and inside.count() > 2000
