"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions import keys as rowkeys
from wayfare.sources import schema as sc


def read_entity(spark: SparkSession, path: str, entity: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Typed entity from a raw text table in any Spark file format (or JDBC)."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        raw = reader.load()
    else:
        raw = reader.schema(sc.raw_schema(sc.raw_ddl(entity))).load(path)
    return sc.typed(raw, entity)


def scan_entity(raw: DataFrame, entity: str, columns: list[str] | None = None) -> DataFrame:
    frame = sc.typed(raw, entity)
    return frame.select(*columns) if columns else frame


def select_family(df: DataFrame, mapping: str, ddl: str) -> DataFrame:
    """Columns of a wide row by position: ``"MM:id , MM:city"`` against a DDL string.

    The frame holds one map or struct column per family. A name without a
    family belongs to the default one; a missing cell is empty text.
    """
    names = raw_names = sc.raw_schema(ddl).fieldNames()
    cells: list[Column] = []
    wanted = [part.strip() for part in mapping.split(",")]
    if len(wanted) != len(names):
        raise ValueError(f"{len(wanted)} cells for {len(names)} columns")
    for item, name in zip(wanted, raw_names, strict=True):
        family, _, qualifier = item.rpartition(":")
        family = family or sc.DEFAULT_FAMILY
        cell = F.try_element_at(F.col(family), F.lit(qualifier)) if isinstance(
            df.schema[family].dataType, T.MapType
        ) else F.col(f"{family}.{qualifier}")
        cells.append(F.coalesce(cell, F.lit("")).alias(name))
    return df.select(*cells)


def scan_key_range(df: DataFrame, key: str, start: str | None = None, stop: str | None = None) -> DataFrame:
    """Rows with ``start <= key < stop``; an empty bound is open. The bounds reach the scan."""
    if start:
        df = df.where(F.col(key) >= F.lit(start))
    if stop:
        df = df.where(F.col(key) < F.lit(stop))
    return df


def key_ranges(df: DataFrame, key: str, split_points: list[str]) -> DataFrame:
    """Rows with the number of the key range they fall in (one range per split point)."""
    number = F.lit(0)
    for i, point in enumerate(sorted(split_points), start=1):
        number = F.when(F.col(key) >= F.lit(point), F.lit(i)).otherwise(number)
    return df.withColumn("key_range", number)


def salted_split_points(buckets: int = rowkeys.DEFAULT_BUCKETS) -> list[str]:
    return [f"{i:04d}" for i in range(1, buckets)]


def source_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per source with its row count, as one lazy frame."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        for name, df in sources.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_history(spark: SparkSession, path: str, start: str = "", end: str = "") -> DataFrame:
    """Facts of the month folders between two ISO dates (inclusive; empty is open)."""
    facts = spark.read.option("basePath", path).schema(
        # the folder name is text, also where all months look like numbers
        spark.read.parquet(path).drop("month").schema.add("month", "string")
    ).parquet(path)
    if start:
        facts = facts.where(F.col("month") >= start[:7])
    if end:
        facts = facts.where(F.col("month") <= end[:7])
    return facts.drop("month")


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """File stream over a file, a folder or a glob."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not any(ch in path for ch in "*?[{"):
        # as a pattern that only this name matches, one file will do as well as a folder of files
        path = path.rstrip("/")
        path = f"{path[:-1]}[{path[-1]}]"
    return reader.load(path)


def stream_topics(spark: SparkSession, brokers: str, pattern: str, max_offsets: int | None = None, starting: str = "earliest", **options: str) -> DataFrame:
    """Message stream by topic pattern: value as text, topic and arrival time.

    Data that the topics lost fails the stream, unless ``failOnDataLoss="false"``
    is given; ``max_offsets`` bounds a batch on request. Needs the Kafka
    connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("value").cast("string").alias("value"), "topic", F.col("timestamp").alias("arrived_at"), "offset"
    )
