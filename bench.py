"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. Each query is run once to
warm up and then BENCH_RUNS times into a no-op sink; the median counts.
``python bench.py --forms`` times the one-pass reports against the same reports
in join form, ``python bench.py name …`` only the named queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "report_completion_city", "report_completion_driver", "report_driver_registrations",
    "report_region_orders", "report_platform_totals", "report_income", "report_hot_cells",
    "report_hot_points", "report_region_users", "report_new_users", "report_active_users",
    "report_retention", "report_virtual_stations", "report_station_counts",
    "filter_day", "filter_quarter", "agg_count_distinct", "agg_sum", "agg_geo_centroid",
    "join_left_chain", "join_full_region", "join_self_cell", "join_track_trip", "join_hot_split",
    "point_in_polygon", "cell_id", "win_latest_per_cell", "win_station_per_cell",
    "trip_state", "active_orders", "hourly_order_count", "position_queue", "last_position",
    "upsert_latest", "upsert_partial", "cdc_apply", "parse_gps", "parse_order_line", "fn_rowkey_salted",
    "html_filter", "task_metrics", "stream_fanout", "stream_trip_state",
]


def seconds(build, runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return statistics.median(once() for _ in range(runs))


def main() -> None:
    from wayfare.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR",
           "spark.ui.showConsoleProgress": "false"},
    )
    args = sys.argv[1:]
    if args == ["--forms"]:
        from tests.join_forms import PAIRS

        plans = {f"{n}_{form}": (lambda b=b: b(spark, folder)) for n, forms in PAIRS.items() for form, b in forms.items()}
    else:
        from wayfare.catalog.queries import QUERIES

        plans = {n: (lambda n=n: QUERIES[n](spark, folder)) for n in (args or HEADLINE)}
    timed = {name: round(seconds(build, runs), 3) for name, build in plans.items()}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": float(scale.group(1)) if scale else folder,
    }))


if __name__ == "__main__":
    main()
