"""Text lines of the message stream: routing, parsing, quarantine.

Frames carry the line in ``value`` beside any other columns (topic, arrival
time, …), which are passed through. Everything works on batch and on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import text as txt
from wayfare.functions import times
from wayfare.operators.pinning import pin
from wayfare.sources.schema import ORDER_LINE

# The token of the export's header line and of a trip's end marker.
HEADER_TOKEN = "dwv_order_make_haikou"
END_TOKEN = "end,"
GPS_FIELDS = 5


def fields(value: Column, separator: str) -> Column:
    """Fields of a line; empty fields at its end do not count."""
    return F.split(F.rtrim(value, F.lit(separator)), separator)


def is_end_marker(value: Column) -> Column:
    """A marker is a whole first field; an id that contains the letters is none."""
    return value.startswith(END_TOKEN)


def line_kind(value: Column) -> Column:
    """``gps`` for more than four commas' worth of fields, ``order`` for tabs, else NULL."""
    return F.when(F.size(fields(value, ",")) >= GPS_FIELDS, F.lit("gps")).when(
        value.contains("\t"), F.lit("order")
    )


def route_lines(lines: DataFrame) -> DataFrame:
    return pin(lines, kind=line_kind(F.col("value"))).where(F.col("kind").isNotNull())


def of_topic(records: DataFrame, topic: str) -> DataFrame:
    return records.where(F.col("topic") == topic)


def parse_gps(lines: DataFrame) -> DataFrame:
    """Position rows and end markers; lines that fail to parse are left out."""
    kept = [c for c in lines.columns if c != "value"]
    cut = pin(lines, _f=fields(F.col("value"), ","), is_end=is_end_marker(F.col("value")))

    def part(i: int) -> Column:
        return F.get("_f", F.lit(i))

    def of_point(value: Column) -> Column:
        return F.when(~F.col("is_end"), value)

    parsed = cut.select(
        *kept,
        F.size("_f").alias("_n"),
        of_point(part(0)).alias("driver_id"),
        part(1).alias("order_id"),
        of_point(part(2).try_cast("bigint")).alias("epoch"),
        of_point(part(3).try_cast("double")).alias("lng"),
        of_point(part(4).try_cast("double")).alias("lat"),
        "is_end",
    )
    complete = (F.col("_n") >= GPS_FIELDS) & F.col("epoch").isNotNull()
    complete = complete & F.col("lng").isNotNull() & F.col("lat").isNotNull()
    marker = F.col("is_end") & (F.col("_n") >= 2)
    return parsed.where(marker | complete).drop("_n")


def gps_events(lines: DataFrame, arrival: str) -> DataFrame:
    """Parsed lines with one event time: the point's own, or a marker's arrival."""
    parsed = parse_gps(lines)
    ts = F.when(F.col("is_end"), F.col(arrival).cast("timestamp")).otherwise(F.timestamp_seconds("epoch"))
    return parsed.withColumn("ts", ts)


def parse_order_lines(lines: DataFrame) -> DataFrame:
    """The 24 fields of an order line; headers and other widths are left out."""
    kept = [c for c in lines.columns if c != "value"]
    plain = lines.where(~F.col("value").contains(HEADER_TOKEN))
    cut = pin(plain, _f=fields(F.col("value"), "\t")).where(F.size("_f") == len(ORDER_LINE))
    return cut.select(*kept, *[F.get("_f", F.lit(i)).alias(name) for i, name in enumerate(ORDER_LINE)])


def order_rows(lines: DataFrame) -> DataFrame:
    """Storage shape of an order line: its key, then the fields."""
    key = F.concat(
        F.col("order_id"), F.lit("_"),
        F.replace("departure_time", F.lit("-"), F.lit("")), F.replace("arrive_time", F.lit(":"), F.lit("")),
    )
    return parse_order_lines(lines).select(key.alias("rowkey"), *ORDER_LINE)


def gps_rows(lines: DataFrame, city_code: str = txt.CITY_PREFIX) -> DataFrame:
    """Storage shape of position lines; markers and short lines are dropped."""
    return parse_gps(lines).where(~F.col("is_end")).select(
        F.concat_ws("_", "order_id", F.col("epoch").cast("string")).alias("rowkey"),
        F.lit(city_code).alias("citycode"),
        F.col("driver_id").alias("driverid"),
        F.col("order_id").alias("orderid"),
        F.col("epoch").alias("timestamp"),
        times.epoch_seconds_text(F.col("epoch")).alias("time"),
        "lng",
        "lat",
    )


def with_reason(lines: DataFrame) -> DataFrame:
    """Every line with the reason it cannot be used, NULL for a good one."""
    value = F.col("value")
    cut = lines.select(
        "*", line_kind(value).alias("_kind"), fields(value, ",").alias("_c"), F.size(fields(value, "\t")).alias("_t")
    )
    numbers = (
        F.get("_c", F.lit(2)).try_cast("bigint").isNotNull()
        & F.get("_c", F.lit(3)).try_cast("double").isNotNull()
        & F.get("_c", F.lit(4)).try_cast("double").isNotNull()
    )
    reason = (
        F.when(is_end_marker(value) & (F.size("_c") < 2), F.lit("end_without_order"))
        .when(is_end_marker(value), F.lit(None).cast("string"))
        .when(F.col("_kind").isNull(), F.lit("unroutable"))
        .when((F.col("_kind") == "gps") & ~numbers, F.lit("bad_number"))
        .when((F.col("_kind") == "order") & value.contains(HEADER_TOKEN), F.lit("header"))
        .when((F.col("_kind") == "order") & (F.col("_t") != len(ORDER_LINE)), F.lit("field_count"))
    )
    return pin(cut, reason=reason).drop("_kind", "_c", "_t")


def quarantine(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good lines, and bad lines with their reason."""
    marked = with_reason(lines)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())
