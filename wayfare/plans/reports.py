"""KPI reports. Each is one scan and at most two narrow shuffles.

The figures of all periods are counted side by side in a single aggregation
per report instead of one aggregation per period joined afterwards.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import text as txt
from wayfare.operators.counting import count_where, distinct_where
from wayfare.operators.periods import NAMES, Day, Periods, as_date, effective, on_day


def _order_counts(as_of: Day, week_mode: str) -> tuple[dict[str, Column], Column]:
    periods = Periods.of(as_of, week_mode)
    ts, done = F.col("create_time"), effective(F.col("cancel"))
    measures = {}
    for name in NAMES:
        measures[f"total_{name}"] = periods.during(name, ts)
        measures[f"eff_{name}"] = periods.during(name, ts) & done
    return measures, periods.any_of(NAMES, ts)


def _rates() -> list[Column]:
    return [
        txt.percent_rounded(F.col(f"eff_{n}"), F.col(f"total_{n}")).alias(f"_{n}_comple_rate") for n in NAMES
    ]


def completion_by_city(orders: DataFrame, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    """Share of effective orders per city; cities with one this year."""
    measures, wanted = _order_counts(as_of, week_mode)
    return city_rates(count_where(orders.where(wanted), ["city_name"], measures))


def city_rates(counts: DataFrame) -> DataFrame:
    """The report's rows from a city's counts per period."""
    kept = counts.where((F.col("eff_year") > 0) & F.col("city_name").isNotNull())
    return kept.select(F.lit("1").alias("rk"), "city_name", *_rates())


def completion_by_driver(orders: DataFrame, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    """The same per driver. A driver who changed name is listed under the newest one."""
    measures, wanted = _order_counts(as_of, week_mode)
    by_name = orders.where(wanted).groupBy("driver_id", "driver_name").agg(
        *[F.count_if(p).alias(n) for n, p in measures.items()], F.max("create_time").alias("seen")
    )
    counts = by_name.groupBy("driver_id").agg(
        F.max(F.struct("seen", "driver_name"))["driver_name"].alias("driver_name"),
        *[F.sum(n).alias(n) for n in measures],
    )
    return driver_rates(counts)


def driver_rates(counts: DataFrame) -> DataFrame:
    """The report's rows from a driver's counts per period."""
    kept = counts.where((F.col("eff_year") > 0) & F.col("driver_id").isNotNull())
    return kept.select(F.col("driver_id").alias("rk"), "driver_id", "driver_name", *_rates())


def driver_registrations(drivers: DataFrame, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    """Drivers registered per city and period; cities with one this year."""
    periods = Periods.of(as_of, week_mode)
    ts = F.col("create_time")
    measures = {f"_register_{n}_num": periods.during(n, ts) for n in NAMES}
    return registration_rows(distinct_where(drivers.where(periods.any_of(NAMES, ts)), ["register_city"], "id", measures))


def registration_rows(counts: DataFrame) -> DataFrame:
    """The report's rows from a city's registrations per period."""
    measures = [f"_register_{n}_num" for n in NAMES]
    kept = counts.where((F.col("_register_year_num") > 0) & F.col("register_city").isNotNull())
    return kept.select(F.col("register_city").alias("rk"), "register_city", *measures)


def region_orders(orders: DataFrame, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    """Vehicles and orders per region; regions with an order this month.

    Orders are summed from the per-vehicle rows, so both kinds of figure come
    from the same shuffle.
    """
    periods = Periods.of(as_of, week_mode)
    ts = F.col("create_time")
    names = ("month", "week", "day")
    per_vehicle = (
        orders.where(periods.any_of(names, ts))
        .groupBy(txt.region4(F.col("begin_address_code")).alias("region"), "vehicle_license")
        .agg(*[F.count_if(periods.during(n, ts)).alias(n) for n in names])
    )
    return region_rows(per_vehicle)


def region_rows(per_vehicle: DataFrame) -> DataFrame:
    """The report's rows from the orders of each vehicle in a region per period."""
    names = ("month", "week", "day")
    known = F.col("vehicle_license").isNotNull()
    regions = per_vehicle.groupBy("region").agg(
        F.count_if(known & (F.col("month") > 0)).alias("monthVehicleCount"),
        F.count_if(known & (F.col("day") > 0)).alias("dayVehicleCount"),
        *[F.sum(n).alias(f"{n}OrderCount") for n in names],
    )
    code = txt.region6(F.col("region"))
    return regions.where(F.col("monthOrderCount") > 0).select(
        code.alias("rk"), "monthVehicleCount", "dayVehicleCount", code.alias("o_begin_address_code"),
        "monthOrderCount", "weekOrderCount", "dayOrderCount",
    )


def platform_totals(orders: DataFrame, as_of: Day) -> DataFrame:
    """Total, monthly and mean daily orders, and mileage, as one row."""
    month = Periods.of(as_of).during("month", F.col("create_time"))
    totals = orders.agg(
        F.count(F.lit(1)).alias("totalOrderNum"),
        F.count_if(month).alias("monthOrderNum"),
        F.min("create_time").alias("first"),
        F.max("create_time").alias("last"),
        F.sum("charge_mileage").alias("charge_mileage"),
    )
    return platform_row(totals)


def platform_row(totals: DataFrame, *more: str) -> DataFrame:
    """The report's row from the totals of all orders."""
    days = F.datediff("last", "first") + 1
    return totals.select(
        F.lit("1").alias("rk"), "totalOrderNum", "monthOrderNum",
        F.round(F.col("totalOrderNum") / days, 2).alias("avgOrderNum"), "charge_mileage", *more,
    )


def income(orders: DataFrame, renters: DataFrame) -> DataFrame:
    """Orders, registered users and income, as one row."""
    parts = orders.agg(
        F.count(F.lit(1)).alias("totalCount"), F.sum("pay_all").alias("pay_all")
    ).unionByName(renters.agg(F.count(F.lit(1)).alias("registerTotalCount")), allowMissingColumns=True)
    return parts.agg(
        F.lit("1").alias("myid"),
        F.max("totalCount").alias("totalCount"),
        F.max("registerTotalCount").alias("registerTotalCount"),
        F.max("pay_all").alias("pay_all"),
    )


def region_users(renters: DataFrame, as_of: Day) -> DataFrame:
    """New and active users of the day per region of last login."""
    new, active = on_day(F.col("create_time"), as_of), on_day(F.col("last_logon_time"), as_of)
    per_user = (
        renters.where((F.col("last_login_city") != "") & (new | active))
        .groupBy(txt.region4(F.col("last_login_city")).alias("region"), "id")
        .agg(F.count_if(new).alias("new"), F.bool_or(active).alias("active"))
    )
    regions = per_user.groupBy("region").agg(
        F.sum("new").alias("_day_new_user"),
        F.count_if(F.col("active") & F.col("id").isNotNull()).alias("DAU"),
    )
    code = txt.region6(F.col("region"))
    return regions.select(code.alias("rk"), code.alias("_city_code"), "_day_new_user", "DAU")


def new_users(renters: DataFrame, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    periods = Periods.of(as_of, week_mode)
    ts = F.col("create_time")
    return renters.agg(
        F.lit("1").alias("myid"),
        *[F.count_if(periods.during(n, ts)).alias(f"{n}NewUserCount") for n in ("month", "week", "day")],
    )


def active_users(renters: DataFrame, as_of: Day, week_mode: str = "any_year") -> DataFrame:
    periods = Periods.of(as_of, week_mode)
    ts = F.col("last_logon_time")
    measures = {"DAU": "day", "WAU": "week", "MAU": "month"}
    wanted = renters.where(periods.any_of(("month", "week", "day"), ts))
    counts = distinct_where(wanted, [], "id", {k: periods.during(n, ts) for k, n in measures.items()})
    return counts.select(F.lit("1").alias("rk"), *measures)


def retention_counts(renters: DataFrame, pairs: dict[str, tuple[Day, Day]]) -> DataFrame:
    """Per pair (cohort day, active day): cohort rows and retained rows, as one row.

    A user contributes (registrations) x (logons), as a left join on the id would.
    """
    created, logged = F.col("create_time"), F.col("last_logon_time")
    flags, sums = [], []
    for name, (cohort_day, active_day) in pairs.items():
        c, a = f"{name}_c", f"{name}_a"
        flags += [
            F.count_if(on_day(created, cohort_day)).alias(c),
            F.count_if(on_day(logged, active_day)).alias(a),
        ]
        sums += [
            F.sum(F.col(c) * F.greatest(F.col(a), F.lit(1))).alias(f"{name}_cohort"),
            F.sum(F.col(c) * F.col(a)).alias(f"{name}_kept"),
        ]
    return renters.where(F.col("id").isNotNull()).groupBy("id").agg(*flags).agg(*sums)


def default_pairs(as_of: Day) -> dict[str, tuple[Day, Day]]:
    d = as_date(as_of)
    return {n: (d - dt.timedelta(days=back), d) for n, back in (("month", 30), ("week", 7), ("day", 1))}


def retention(renters: DataFrame, pairs: dict[str, tuple[Day, Day]]) -> DataFrame:
    """Next-day, week and month retention, each in its own text format."""
    counts = retention_counts(renters, pairs)

    def rate(fmt, name: str) -> Column:
        text = fmt(F.col(f"{name}_kept"), F.col(f"{name}_cohort"))
        return F.coalesce(text, F.lit(txt.ZERO_RATE)).alias(f"{name}StateRate")

    return counts.select(
        F.lit("1").alias("myid"),
        rate(txt.percent_raw, "month"),
        rate(txt.percent_raw, "week"),
        rate(txt.percent_decimal, "day"),
    )
