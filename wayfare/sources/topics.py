"""Record logs with offsets, and a streaming source over them.

A log is a list of live folders (``manifests``). Each append adds one file per
partition it has records for, and the manifest gives the file its first offset: two
writers at once get ranges one after the other, and a file is never changed. Old
records are dropped from the front of a partition.

The source follows the log by offsets, as a message topic is followed: it starts at
the earliest or the latest record or at given offsets, takes so many records a batch
at most, and fails where records it has not read are gone, unless that is allowed.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from wayfare.sources import manifests
from wayfare.sources.manifests import Manifest, Part
from wayfare.sources.sinks import kept

FORMAT = "record_log"
PARTITION = "log_partition"


def append_records(records: DataFrame, path: str, partition: str, order: list[str]) -> None:
    """Append records to a log, by the number in column ``partition`` and in the given order within it. Null partitions are 0."""
    spark = records.sparkSession
    number = F.coalesce(F.col(partition).cast("int"), F.lit(0))
    with kept(records.withColumn(PARTITION, number)) as numbered:
        counts = {r[PARTITION]: r["n"] for r in numbered.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}  # one row per partition
        folder = manifests.new_folder()
        # a partition is one file, in whose order its offsets run
        one_file = numbered.repartition(max(1, len(counts)), PARTITION).sortWithinPartitions(PARTITION, *order)
        one_file.write.partitionBy(PARTITION).option("maxRecordsPerFile", 0).parquet(f"{path}/{folder}")
    columns = manifests.columns_of(records)

    def edit(now: Manifest | None) -> Manifest:
        now = now or Manifest(0, columns)
        ends = {int(p): n for p, n in now.runs.items()}
        added = [Part(f"{folder}/{PARTITION}={p}", bucket=p, level=n, batch=ends.get(p, 0)) for p, n in sorted(counts.items())]
        return replace(now, parts=(*now.parts, *added), runs=now.runs | {str(p): ends.get(p, 0) + n for p, n in counts.items()})

    manifests.commit(spark, path, edit)


def drop_records(spark: SparkSession, path: str, before: dict[int, int]) -> None:
    """Drop the files of each partition whose records all stand before an offset."""

    def edit(now: Manifest | None) -> Manifest:
        if now is None:
            raise FileNotFoundError(path)
        return replace(now, parts=tuple(p for p in now.parts if p.batch + p.level > before.get(p.bucket, 0)))

    manifests.commit(spark, path, edit)


def _source() -> type[DataSource]:
    """The source's class, made here so that it travels to the workers by value: they need no package of ours."""
    import json
    from collections.abc import Iterator

    from pyspark.sql import types as T
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class Slice(InputPartition):
        def __init__(self, folder: str, partition: int, first: int, start: int, stop: int):
            self.folder, self.partition, self.first, self.start, self.stop = folder, partition, first, start, stop

    def opened(path: str) -> tuple:
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)

    class LogReader(DataSourceStreamReader):
        def __init__(self, options: dict[str, str], schema: T.StructType):
            self.path, self.columns = options["path"], [n for n in schema.names if n not in ("partition", "offset")]
            self.starting = options.get("startingoffsets", options.get("startingOffsets", "earliest"))
            self.fail = options.get("failondataloss", options.get("failOnDataLoss", "true")) == "true"
            most = options.get("maxoffsetspertrigger", options.get("maxOffsetsPerTrigger"))
            self.most = int(most) if most else None
            self.at: dict[str, int] | None = None

        def log(self) -> dict:
            from pyarrow import fs

            store, path = opened(f"{self.path}/_manifests")
            names = sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".json"))
            with store.open_input_stream(names[-1]) as file:
                return json.loads(file.read().decode("utf-8"))

        def firsts(self, log: dict) -> dict[str, int]:
            """The earliest record of each partition that is still there."""
            out = dict(log["runs"])
            for part in log["parts"]:
                out[str(part["bucket"])] = min(out[str(part["bucket"])], part["batch"])
            return out

        def initialOffset(self) -> dict:
            log = self.log()
            if self.starting == "earliest":
                return self.firsts(log)
            return dict(log["runs"]) if self.starting == "latest" else json.loads(self.starting)

        def latestOffset(self) -> dict:
            """The end of the log, or so many records after the batch before, dealt evenly."""
            log = self.log()
            ends = log["runs"]
            if self.most is None:
                return dict(ends)
            at = self.at if self.at is not None else self.initialOffset()
            out, left = dict(at), self.most
            open_ones = sorted(p for p in ends if at.get(p, 0) < ends[p])
            for turn, p in enumerate(open_ones):
                take = min(ends[p] - at.get(p, 0), -(-left // (len(open_ones) - turn)))
                out[p], left = at.get(p, 0) + take, left - take
            return out

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            self.at, log = end, self.log()
            firsts, out = self.firsts(log), []
            for p, first in firsts.items():
                if start.get(p, 0) < min(first, end.get(p, 0)) and self.fail:
                    raise ValueError(f"records {start.get(p, 0)} to {min(first, end.get(p, 0)) - 1} of partition {p} are gone")
            for part in log["parts"]:
                p = str(part["bucket"])
                low, high = max(start.get(p, 0), part["batch"]), min(end.get(p, 0), part["batch"] + part["level"])
                if low < high:
                    out.append(Slice(f"{self.path}/{part['folder']}", part["bucket"], part["batch"], low, high))
            return out

        def read(self, partition: InputPartition) -> Iterator:
            import pyarrow as pa
            import pyarrow.dataset as ds

            store, path = opened(partition.folder)
            table = ds.dataset(path, filesystem=store, format="parquet").to_table(columns=self.columns)
            table = table.slice(partition.start - partition.first, partition.stop - partition.start)
            table = table.append_column("partition", pa.array([partition.partition] * table.num_rows, pa.int32()))
            table = table.append_column("offset", pa.array(range(partition.start, partition.stop), pa.int64()))
            yield from (tuple(row.values()) for row in table.to_pylist())

        def commit(self, end: dict) -> None:
            self.at = end

    class RecordLog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "record_log"

        def schema(self) -> T.StructType:
            schema = T.StructType.fromJson(json.loads(self.options["columns"]))
            return schema.add("partition", T.IntegerType()).add("offset", T.LongType())

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            return LogReader(dict(self.options), schema)

    return RecordLog


def stream_records(spark: SparkSession, path: str, starting: str = "earliest", max_offsets: int | None = None, fail_on_loss: bool = True) -> DataFrame:
    """The records of a log as a stream, with ``partition`` and ``offset``.

    ``starting`` is "earliest", "latest" or JSON text of partition numbers to offsets.
    """
    now = manifests.newest(spark, path)
    if now is None:
        raise FileNotFoundError(path)
    spark.dataSource.register(_source())
    reader = spark.readStream.format(FORMAT).option("path", path).option("columns", now.columns)
    reader = reader.option("startingOffsets", starting).option("failOnDataLoss", json.dumps(fail_on_loss))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return reader.load()
