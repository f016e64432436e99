"""Key ranges of a keyed table as a data source: one input partition per range.

A keyed table is cut into buckets by key range, and its manifest knows them. A scan
of some keys makes one partition per bucket that may hold such keys; no other file
is opened, and each partition hands the bounds on to the Parquet reader.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from wayfare.sources import manifests

FORMAT = "key_ranges"


def _source() -> type[DataSource]:
    """The source's class, made here so that it travels to the workers by value: they need no package of ours."""
    import json
    from collections.abc import Iterator

    from pyspark.sql import types as T
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class KeyRangeReader(DataSourceReader):
        def __init__(self, options: dict[str, str], schema: T.StructType):
            self.folders, self.key = json.loads(options["folders"]), options["key"]
            self.start, self.stop, self.columns = options.get("start"), options.get("stop"), schema

        def partitions(self) -> list[InputPartition]:
            return [InputPartition(folder) for folder in self.folders]

        def read(self, partition: InputPartition) -> Iterator:
            import pyarrow as pa
            import pyarrow.dataset as ds
            from pyarrow import fs
            from pyspark.sql.pandas.types import to_arrow_schema

            if partition.value is None:  # no range overlaps; Spark asks for one partition all the same
                return
            folder = partition.value
            store, path = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
            wanted = ds.field(self.key).is_valid()
            if self.start is not None:
                wanted &= ds.field(self.key) >= self.start
            if self.stop is not None:
                wanted &= ds.field(self.key) < self.stop
            files = ds.dataset(path, filesystem=store, format="parquet")
            types = to_arrow_schema(self.columns)
            for batch in files.to_batches(columns=self.columns.names, filter=wanted):
                yield from pa.Table.from_batches([batch]).cast(types, safe=False).to_batches()

    class KeyRanges(DataSource):
        @classmethod
        def name(cls) -> str:
            return "key_ranges"

        def schema(self) -> T.StructType:
            return T.StructType.fromJson(json.loads(self.options["columns"]))

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return KeyRangeReader(self.options, schema)

    return KeyRanges


def overlapping(bounds: tuple[str, ...], start: str | None, stop: str | None) -> range:
    """Numbers of the buckets that may hold keys in [start, stop)."""
    first = bisect_right(bounds, start) if start is not None else 0
    last = bisect_left(bounds, stop) if stop is not None else len(bounds)
    return range(first, last + 1)


def read_key_range(spark: SparkSession, path: str, key: str, start: str | None = None, stop: str | None = None) -> DataFrame:
    """Rows with ``start <= key < stop`` (None is open) of a table keyed by one text column; no rows if stop is not after start."""
    now = manifests.newest(spark, path)
    if now is None:
        raise FileNotFoundError(path)
    if start is not None and stop is not None and stop <= start:
        return spark.createDataFrame([], now.schema)
    wanted = overlapping(now.bounds, start, stop)
    folders = [f"{path}/{p.folder}" for p in sorted(now.parts, key=lambda p: p.bucket or 0) if p.bucket in wanted]
    spark.dataSource.register(_source())
    reader = spark.read.format(FORMAT).option("columns", now.columns).option("folders", json.dumps(folders or [None])).option("key", key)
    for name, value in (("start", start), ("stop", stop)):
        if value is not None:
            reader = reader.option(name, value)
    return reader.load()
