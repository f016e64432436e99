"""Calendar predicates of a report, all derived from one ``as_of`` date.

Day, month, quarter and year are half-open ranges on the raw timestamp, so they
reach the scan as pushed filters. A week is compared by its ISO number in any
year by default (that is what the reports mean); ``week_mode="iso_year"`` makes
it a range as well. For scans, the any-year week is spelled out as one range
per year, so that files of the other weeks can still be skipped.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Day = str | dt.date
NAMES = ("year", "quarter", "month", "week", "day")
# years around as_of whose weeks are spelled out as ranges
YEARS_BACK, YEARS_AHEAD = 15, 1


def as_date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def in_range(ts: Column, start: dt.date, end: dt.date) -> Column:
    """Half-open range; the bounds take the type of the column (timestamp, date or text)."""
    return (ts >= start.isoformat()) & (ts < end.isoformat())


def on_day(ts: Column, day: str | dt.date) -> Column:
    day = as_date(day)
    return in_range(ts, day, day + dt.timedelta(days=1))


@dataclass(frozen=True)
class Periods:
    as_of: dt.date
    week_mode: str = "any_year"

    @classmethod
    def of(cls, as_of: str | dt.date, week_mode: str = "any_year") -> "Periods":
        if week_mode not in ("any_year", "iso_year"):
            raise ValueError(f"unknown week_mode {week_mode!r}")
        return cls(as_date(as_of), week_mode)

    def bounds(self, name: str) -> tuple[dt.date, dt.date]:
        d = self.as_of
        if name == "day":
            return d, d + dt.timedelta(days=1)
        if name == "week":
            monday = d - dt.timedelta(days=d.weekday())
            return monday, monday + dt.timedelta(days=7)
        if name == "year":
            return dt.date(d.year, 1, 1), dt.date(d.year + 1, 1, 1)
        span = {"month": 1, "quarter": 3}[name]
        first = d.year * 12 + (d.month - 1) // span * span
        return dt.date(first // 12, first % 12 + 1, 1), dt.date((first + span) // 12, (first + span) % 12 + 1, 1)

    def during(self, name: str, ts: Column) -> Column:
        if name == "week" and self.week_mode == "any_year":
            return F.weekofyear(ts) == F.lit(self.as_of.isocalendar().week)
        return in_range(ts, *self.bounds(name))

    def scan(self, name: str, ts: Column) -> Column:
        """A condition every row of the period meets, made of ranges a scan can prune by."""
        if name == "week" and self.week_mode == "any_year":
            return self._week_of_many_years(ts)
        return self.during(name, ts)

    def _week_of_many_years(self, ts: Column) -> Column:
        """Any range of the spelled-out years, or a time outside those years."""
        week = self.as_of.isocalendar().week
        first, last = max(1, self.as_of.year - YEARS_BACK), self.as_of.year + YEARS_AHEAD
        start, end = dt.date.fromisocalendar(first, 1, 1), dt.date.fromisocalendar(last + 1, 1, 1)
        possible = [ts < start.isoformat(), ts >= end.isoformat()]
        for year in range(first, last + 1):
            monday = dt.date.fromisocalendar(year, 1, 1) + dt.timedelta(weeks=week - 1)
            if monday.isocalendar().week == week:  # a year may have no week 53
                possible.append(in_range(ts, monday, monday + dt.timedelta(days=7)))
        return reduce(lambda a, b: a | b, possible)

    def any_of(self, names: tuple[str, ...], ts: Column) -> Column:
        """Ranges that hold all rows of the periods (and may hold others)."""
        outer = [n for n in NAMES if n in names]
        kept = [
            n for n in outer
            if not any(m != n and self._encloses(m, n) for m in outer)
        ]
        return reduce(lambda a, b: a | b, [self.scan(n, ts) for n in kept])

    def _encloses(self, big: str, small: str) -> bool:
        if self.week_mode == "any_year" and "week" in (big, small):
            return big == "week" and small == "day"
        (a, b), (c, d) = self.bounds(big), self.bounds(small)
        return a <= c and d <= b


def filter_period(df: DataFrame, ts: str, name: str, as_of: str | dt.date, week_mode: str = "any_year") -> DataFrame:
    periods = Periods.of(as_of, week_mode)
    return df.where(periods.scan(name, F.col(ts)) & periods.during(name, F.col(ts)))


def filter_since(df: DataFrame, ts: str, start: str | dt.date) -> DataFrame:
    return df.where(F.col(ts) >= as_date(start).isoformat())


def effective(cancel: Column) -> Column:
    """An order nobody cancelled."""
    return cancel.try_cast("int") == 0
