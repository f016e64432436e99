"""The whole batch: all reports of a date, each failure kept to its own report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.plans import hot, reports, stations
from wayfare.sources.sinks import upsert_report, write_report


@dataclass
class Outcome:
    frame: DataFrame | None = None
    error: str | None = None


@contextmanager
def cached(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep source frames for the reports that share them; spills to disk."""
    kept = tuple(f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames)
    try:
        yield kept
    finally:
        for f in kept:
            f.unpersist()


@contextmanager
def named_views(sources: dict[str, DataFrame]) -> Iterator[dict[str, DataFrame]]:
    """Sources as cached temporary views for SQL users; both are gone afterwards.

    ``order`` is a SQL word, so quote it: ``select * from `order```.
    """
    with cached(*sources.values()) as kept:
        frames = dict(zip(sources, kept, strict=True))
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
        try:
            yield frames
        finally:
            for name, frame in frames.items():
                frame.sparkSession.catalog.dropTempView(name)


def plan_reports(sources: dict[str, DataFrame], as_of: str | dt.date) -> dict[str, Callable[[], DataFrame]]:
    order, renter, driver = sources["order"], sources["renter"], sources["driver"]
    plan = {
        "completion_city": lambda: reports.completion_by_city(order, as_of),
        "completion_driver": lambda: reports.completion_by_driver(order, as_of),
        "driver_registrations": lambda: reports.driver_registrations(driver, as_of),
        "region_orders": lambda: reports.region_orders(order, as_of),
        "platform_totals": lambda: reports.platform_totals(order, as_of),
        "income": lambda: reports.income(order, renter),
        "hot_cells": lambda: hot.hot_cells(order, as_of),
        "hot_points": lambda: hot.hot_points(order, as_of),
        "region_users": lambda: reports.region_users(renter, as_of),
        "new_users": lambda: reports.new_users(renter, as_of),
        "active_users": lambda: reports.active_users(renter, as_of),
        "retention": lambda: reports.retention(renter, reports.default_pairs(as_of)),
    }
    if "station_order" in sources and "district" in sources:
        plan["virtual_stations"] = lambda: stations.stations_by_district(
            sources["station_order"], sources["district"]
        )
    return plan


REPORT_KEYS = {
    "completion_city": "city_name", "completion_driver": "driver_id",
    "driver_registrations": "register_city", "region_orders": "rk", "platform_totals": "rk",
    "income": "myid", "hot_cells": "_city_code", "hot_points": "rk", "region_users": "rk",
    "new_users": "myid", "active_users": "rk", "retention": "myid", "virtual_stations": "order_id",
}


def run_all(sources: dict[str, DataFrame], as_of: str | dt.date) -> dict[str, Outcome]:
    """Lazy frames of all reports; a report that cannot be planned carries its error."""
    outcomes = {}
    for name, build in plan_reports(sources, as_of).items():
        try:
            outcomes[name] = Outcome(frame=build())
        except Exception as error:  # noqa: BLE001 - one bad source must not stop the others
            outcomes[name] = Outcome(error=str(error))
    return outcomes


def write_all(outcomes: dict[str, Outcome], folder: str) -> dict[str, str | None]:
    """Replace the table of every planned report; returns the error of each, None when written."""
    return _each(outcomes, lambda name, frame: write_report(frame, f"{folder}/{name}", REPORT_KEYS[name]))


def upsert_all(outcomes: dict[str, Outcome], folder: str, as_of: str | dt.date) -> dict[str, str | None]:
    """Put every planned report into its table by key, as a wide-row store would: a key has one row, that of the newest day.

    Rows of keys that the new report lacks stay, with the day (``as_of``) they are from.
    Of several rows of a report with one key the greatest by its other columns stays.
    """

    def put(name: str, frame: DataFrame) -> None:
        dated = frame.withColumn("as_of", F.lit(str(as_of)))
        upsert_report(dated, f"{folder}/{name}", [REPORT_KEYS[name]], ["as_of"])

    return _each(outcomes, put)


def _each(outcomes: dict[str, Outcome], write: Callable[[str, DataFrame], None]) -> dict[str, str | None]:
    errors: dict[str, str | None] = {}
    for name, outcome in outcomes.items():
        errors[name] = outcome.error
        if outcome.frame is None:
            continue
        try:
            write(name, outcome.frame)
        except Exception as error:  # noqa: BLE001
            errors[name] = str(error)
    return errors
