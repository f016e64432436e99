"""Distinct users over rolling periods, from one bitmap per day.

Every user has a place: a bucket by hash and a number in it, of which a bitmap per
(day, bucket) holds one bit. Days, weeks and months are unions of these bitmaps, so
all figures of any number of days come from one pass over the logons, and they are
exact. Retention is the intersection of a day's new users with a later day's users.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.operators.periods import Day, as_date, in_range

#: Places in one bitmap, as the bitmap functions have it, and users that are meant to share one.
BITMAP_PLACES = 32768
USERS_PER_BUCKET = 24_000
SPANS = {"DAU": 1, "WAU": 7, "MAU": 30}


def user_places(users: DataFrame, user: str, n_users: int | None = None) -> DataFrame:
    """user, bucket, place: a place of its own for every distinct user; null users have none.

    Numbers are given within hashed buckets, so no task sees all users; a bucket that
    got more users than a bitmap has places goes on in further ones.
    """
    known = users.select(F.col(user).alias("user")).where(F.col("user").isNotNull()).distinct()
    buckets = max(1, -(-(known.count() if n_users is None else n_users) // USERS_PER_BUCKET))
    hashed = known.withColumn("hashed", F.pmod(F.xxhash64("user"), F.lit(buckets)))
    number = F.row_number().over(Window.partitionBy("hashed").orderBy("user")) - 1
    numbered = hashed.withColumn("number", number)
    bucket = F.col("hashed") + buckets * F.floor(F.col("number") / BITMAP_PLACES)
    return numbered.select("user", bucket.alias("bucket"), (F.col("number") % BITMAP_PLACES).cast("bigint").alias("place"))


def daily_bitmaps(logons: DataFrame, places: DataFrame, user: str, ts: str) -> DataFrame:
    """day, bucket, bits: who logged on, one bitmap per day and bucket."""
    days = logons.select(F.col(user).alias("user"), F.to_date(ts).alias("day")).where(F.col("day").isNotNull())
    once = days.distinct()  # before the join, so that a user who logs on all day is one row
    return once.join(places, "user").groupBy("day", "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))


def _days(first: dt.date, last: dt.date) -> Column:
    return F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day")


def rolling_counts(bitmaps: DataFrame, first: Day, last: Day, spans: dict[str, int] | None = None) -> DataFrame:
    """day and the distinct users of the days up to it, for each span; every day from ``first`` to ``last`` has a row."""
    spans, first, last = spans or SPANS, as_date(first), as_date(last)
    reach = max(spans.values())
    near = bitmaps.where((F.col("day") > F.lit(first - dt.timedelta(days=reach))) & (F.col("day") <= F.lit(last)))
    # every bucket needs a row on every day, also where nobody logged on
    grid = near.select("bucket").distinct().select(_days(first, last), "bucket", F.lit(bytes(BITMAP_PLACES // 8)).alias("bits"))
    rows = near.unionByName(grid).groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    number = F.unix_date("day")
    counted = rows.withColumns({
        name: F.bitmap_count(F.bitmap_or_agg("bits").over(Window.partitionBy("bucket").orderBy(number).rangeBetween(1 - span, 0)))
        for name, span in spans.items()
    })
    totals = counted.where(F.col("day") >= F.lit(first)).groupBy("day").agg(*[F.sum(name).alias(name) for name in spans])
    every = logless_days(bitmaps, first, last)
    return every.join(totals, "day", "left").select("day", *[F.coalesce(name, F.lit(0)).alias(name) for name in spans])


def logless_days(bitmaps: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day."""
    return bitmaps.sparkSession.range(1).select(_days(first, last))


def rolling_active_users(logons: DataFrame, user: str, ts: str, as_of: Day, days: int = 60, spans: dict[str, int] | None = None) -> DataFrame:
    """DAU, WAU and MAU of each of the last ``days`` days up to ``as_of``."""
    last = as_date(as_of)
    first = last - dt.timedelta(days=days - 1)
    reach = first - dt.timedelta(days=max((spans or SPANS).values()) - 1)
    wanted = logons.where(in_range(F.col(ts), reach, last + dt.timedelta(days=1)))
    return rolling_counts(daily_bitmaps(wanted, user_places(wanted, user), user, ts), first, last, spans)


def cohort_retention(created: DataFrame, logged: DataFrame, first: Day, last: Day, after: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """day, days_after, cohort, retained: users new on a day, and those of them who logged on so many days later.

    ``created`` and ``logged`` are daily bitmaps over the same places.
    """
    first, last = as_date(first), as_date(last)
    new = created.where(F.col("day").between(F.lit(first), F.lit(last)))
    asked = new.select("day", "bucket", "bits", F.explode(F.array(*[F.lit(n) for n in after])).alias("days_after"))
    later = logged.select(F.col("day").alias("on_day"), F.col("bucket").alias("in_bucket"), F.col("bits").alias("seen"))
    met = asked.join(later, (F.date_add("day", F.col("days_after")) == F.col("on_day")) & (F.col("bucket") == F.col("in_bucket")), "left")
    both = F.array(F.col("bits"), F.coalesce("seen", F.lit(bytes(BITMAP_PLACES // 8))))
    pair = met.select("day", "days_after", "bucket", F.bitmap_count("bits").alias("cohort"), F.explode(both).alias("bits"))
    kept = pair.groupBy("day", "days_after", "bucket", "cohort").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("retained"))
    return kept.groupBy("day", "days_after").agg(F.sum("cohort").alias("cohort"), F.sum("retained").alias("retained"))
