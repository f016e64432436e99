"""Reports from daily partial results.

Each table has one row per day and key whose figures can be merged: counts, sums,
least and greatest times. A new day reads the facts of that day alone and replaces
that day's rows in one key range of the table; the reports merge the days of their
periods and equal those made from all facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import text as txt
from wayfare.operators.periods import NAMES, Day, Periods, as_date, effective
from wayfare.plans import reports
from wayfare.sources.sinks import read_report, replace_range

DAY = "day"


@dataclass(frozen=True)
class Partial:
    """What is kept per day: keys, and merges of the facts' columns."""

    keys: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]

    @property
    def table_keys(self) -> list[str]:
        return [DAY, *self.keys]


def _per(facts: DataFrame, keys: dict[str, Column], *figures: Column) -> DataFrame:
    """Figures per day and key. Missing parts of a key are a text of their own, since a table has no null keys."""
    named = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")).alias(n) for n, c in keys.items()]
    return facts.withColumn(DAY, F.to_date("create_time")).groupBy(DAY, *named).agg(*figures)


def _key(name: str) -> Column:
    """A key as it was: NULL where it was missing."""
    return F.when(F.col(name) != "", F.substring(name, 2, 1 << 30)).alias(name)


def _rows() -> Column:
    return F.count(F.lit(1))


def _city(orders: DataFrame) -> DataFrame:
    return _per(orders, {"city_name": F.col("city_name")}, _rows().alias("total"), F.count_if(effective(F.col("cancel"))).alias("eff"))


def _driver(orders: DataFrame) -> DataFrame:
    return _per(
        orders, {"driver_id": F.col("driver_id"), "driver_name": F.col("driver_name")},
        _rows().alias("total"), F.count_if(effective(F.col("cancel"))).alias("eff"), F.max("create_time").alias("seen"),
    )


def _registered(drivers: DataFrame) -> DataFrame:
    return _per(drivers, {"register_city": F.col("register_city"), "id": F.col("id")}, _rows().alias("n"))


def _vehicle(orders: DataFrame) -> DataFrame:
    return _per(orders, {"region": txt.region4(F.col("begin_address_code")), "vehicle_license": F.col("vehicle_license")}, _rows().alias("n"))


def _platform(orders: DataFrame) -> DataFrame:
    return _per(
        orders, {}, _rows().alias("total"), F.min("create_time").alias("first"), F.max("create_time").alias("last"),
        F.sum("charge_mileage").alias("charge_mileage"), F.sum("pay_all").alias("pay_all"),
    )


PARTIALS = {
    "completion_city": Partial(("city_name",), _city), "completion_driver": Partial(("driver_id", "driver_name"), _driver),
    "driver_registrations": Partial(("register_city", "id"), _registered), "region_orders": Partial(("region", "vehicle_license"), _vehicle),
    "platform": Partial((), _platform),
}


def update_days(facts: DataFrame, path: str, name: str, first: Day, last: Day | None = None) -> None:
    """Replaces the partial results of some days by those of the facts; reads the facts of these days alone.

    A day that has no facts any more loses its rows. Facts without a time belong to no day.
    """
    partial, first = PARTIALS[name], as_date(first)
    last = first if last is None else as_date(last)
    ts = F.col("create_time")
    wanted = facts.where((ts >= first.isoformat()) & (ts < (last + dt.timedelta(days=1)).isoformat()))
    replace_range(partial.build(wanted), f"{path}/{name}", partial.table_keys, first.isoformat(), f"{last.isoformat()}\x7f")


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    days = read_report(spark, f"{path}/{name}")
    return days.select(*[_key(c) if c in PARTIALS[name].keys else F.col(c) for c in days.columns])


def _period_sums(as_of: Day, week_mode: str, figures: dict[str, str], names: tuple[str, ...] = NAMES) -> list[Column]:
    """Per period the sum of each figure over its days."""
    periods = Periods.of(as_of, week_mode)
    return [
        F.coalesce(F.sum(F.when(periods.during(n, F.col(DAY)), F.col(figure))), F.lit(0)).alias(f"{prefix}{n}")
        for n in names for prefix, figure in figures.items()
    ]


def _wanted(as_of: Day, week_mode: str, names: tuple[str, ...] = NAMES) -> Column:
    return Periods.of(as_of, week_mode).any_of(names, F.col(DAY))


_RATES = {"total_": "total", "eff_": "eff"}


def completion_by_city(spark: SparkSession, path: str, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    days = _read(spark, path, "completion_city").where(_wanted(as_of, week_mode))
    return reports.city_rates(days.groupBy("city_name").agg(*_period_sums(as_of, week_mode, _RATES)))


def completion_by_driver(spark: SparkSession, path: str, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    days = _read(spark, path, "completion_driver").where(_wanted(as_of, week_mode))
    newest = F.max(F.struct("seen", "driver_name"))["driver_name"].alias("driver_name")
    return reports.driver_rates(days.groupBy("driver_id").agg(newest, *_period_sums(as_of, week_mode, _RATES)))


def driver_registrations(spark: SparkSession, path: str, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    periods = Periods.of(as_of, week_mode)
    days = _read(spark, path, "driver_registrations").where(_wanted(as_of, week_mode) & F.col("id").isNotNull())
    flags = days.groupBy("register_city", "id").agg(*[F.bool_or(periods.during(n, F.col(DAY))).alias(n) for n in NAMES])
    counts = flags.groupBy("register_city").agg(*[F.count_if(n).alias(f"_register_{n}_num") for n in NAMES])
    return reports.registration_rows(counts)


def region_orders(spark: SparkSession, path: str, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    names = ("month", "week", "day")
    days = _read(spark, path, "region_orders").where(_wanted(as_of, week_mode, names))
    return reports.region_rows(days.groupBy("region", "vehicle_license").agg(*_period_sums(as_of, week_mode, {"": "n"}, names)))


def platform_totals(spark: SparkSession, path: str, as_of: Day) -> DataFrame:
    """Totals and income of all days, as ``reports.platform_totals`` and the order part of ``reports.income``, as one row."""
    month = Periods.of(as_of).during("month", F.col(DAY))
    totals = _read(spark, path, "platform").agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("totalOrderNum"), F.coalesce(F.sum(F.when(month, F.col("total"))), F.lit(0)).alias("monthOrderNum"),
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("charge_mileage").alias("charge_mileage"), F.sum("pay_all").alias("pay_all"),
    )
    return reports.platform_row(totals, "pay_all")

