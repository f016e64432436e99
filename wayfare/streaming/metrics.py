"""Job metrics as data: stream progress, task metrics, dashboard ratios."""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wayfare.operators.pinning import pin

BLOCKED_MS = 30_000
GC_LIMIT_PERCENT = 30.0

PROGRESS_DDL = (
    "id string, runId string, name string, timestamp string, batchId bigint, numInputRows bigint, "
    "inputRowsPerSecond double, processedRowsPerSecond double, durationMs map<string,bigint>, "
    "eventTime map<string,string>, "
    "sources array<struct<description:string,numInputRows:bigint,processedRowsPerSecond:double>>, "
    "sink struct<description:string>, "
    "stateOperators array<struct<numRowsTotal:bigint,numRowsUpdated:bigint,memoryUsedBytes:bigint>>, "
    "gcMs bigint"
)
PHASES = {"addBatch": "add_batch_ms", "getBatch": "get_batch_ms", "walCommit": "wal_commit_ms",
          "queryPlanning": "query_planning_ms", "commitOffsets": "commit_offsets_ms"}


EVENTS_DDL = "event string, query_id string, value string, gc_ms bigint, received_at timestamp"


def _gc_ms(spark: SparkSession) -> int | None:
    """Garbage collection time of the driver so far; unknown where the session has no JVM of its own."""
    try:
        beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    except Exception:  # noqa: BLE001 - a remote session has no such attribute
        return None
    return sum(max(0, bean.getCollectionTime()) for bean in beans)


class ProgressRecorder(StreamingQueryListener):
    """Appends every event of all queries to a Parquet table, as JSON text.

    Events wait in memory until ``flush_every`` of them are there, the oldest is
    ``flush_seconds`` old when another one (or an idle query's) comes, or a query ends;
    those that wait are lost with the driver. ``gc_ms`` is the driver's collection time
    since the progress event before.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 100, flush_seconds: float = 30):
        self._spark, self._path, self._flush_every, self._flush_seconds = spark, path, flush_every, flush_seconds
        self._gc_before = _gc_ms(spark)
        self._waiting: list[tuple[str, str, str, int | None, dt.datetime]] = []
        self._lock, self._ended = threading.Condition(), set()

    def _note(self, kind: str, query_id: str, value: str, gc_ms: int | None = None) -> None:
        with self._lock:
            self._waiting.append((kind, query_id, value, gc_ms, dt.datetime.now(dt.timezone.utc)))
        self._flush_due()

    def _flush_due(self) -> None:
        with self._lock:
            if not self._waiting:
                return
            age = (dt.datetime.now(dt.timezone.utc) - self._waiting[0][-1]).total_seconds()
            if len(self._waiting) >= self._flush_every or age >= self._flush_seconds:
                self.flush()

    def _gc_since(self) -> int | None:
        with self._lock:
            before, self._gc_before = self._gc_before, _gc_ms(self._spark)
            return None if before is None or self._gc_before is None else self._gc_before - before

    def onQueryStarted(self, event) -> None:
        self._note("started", str(event.id), f'{{"id":"{event.id}","timestamp":"{event.timestamp}"}}')

    def onQueryProgress(self, event) -> None:
        self._note("progress", str(event.progress.id), event.progress.json, self._gc_since())

    def onQueryIdle(self, event) -> None:
        self._flush_due()

    def onQueryTerminated(self, event) -> None:
        self._note("terminated", str(event.id), f'{{"id":"{event.id}"}}')
        with self._lock:
            self.flush()
            self._ended.add(str(event.id))
            self._lock.notify_all()

    def flush(self) -> None:
        """Write what is waiting."""
        with self._lock:
            if self._waiting:
                self._spark.createDataFrame(self._waiting, EVENTS_DDL).coalesce(1).write.mode("append").parquet(self._path)
                self._waiting = []

    def wait_for(self, query, timeout: float = 60) -> None:
        """Until the end of a query has been written."""
        with self._lock:
            if not self._lock.wait_for(lambda: str(query.id) in self._ended, timeout):
                raise TimeoutError(f"no end of query {query.id} after {timeout} s")

    def events(self, last_seconds: int | None = None) -> DataFrame:
        return recorded_events(self._spark, self._path, last_seconds)

    def progress(self, last_seconds: int | None = None) -> DataFrame:
        return flatten_progress(self.events(last_seconds).where("event = 'progress'"))


def recorded_events(spark: SparkSession, path: str, last_seconds: int | None = None) -> DataFrame:
    """Events that a recorder wrote, of the last seconds if given."""
    events = spark.read.schema(EVENTS_DDL).parquet(path)
    if last_seconds is None:
        return events
    return events.where(F.col("received_at") >= F.current_timestamp() - F.make_dt_interval(secs=F.lit(last_seconds)))


def progress_sources(events: DataFrame) -> DataFrame:
    """One row per batch and source, from progress JSON in ``value``."""
    p = events.select(F.from_json("value", PROGRESS_DDL).alias("p"))
    return p.select(
        F.col("p.id").alias("query_id"), F.col("p.name").alias("query_name"), F.col("p.batchId").alias("batch_id"),
        F.posexplode("p.sources").alias("source_index", "s"),
    ).select(
        "query_id", "query_name", "batch_id", "source_index", F.col("s.description").alias("source"),
        F.col("s.numInputRows").alias("source_rows"), F.col("s.processedRowsPerSecond").alias("rows_per_second"),
    )


def progress_states(events: DataFrame) -> DataFrame:
    """One row per batch and stateful operator, from progress JSON in ``value``."""
    p = events.select(F.from_json("value", PROGRESS_DDL).alias("p"))
    return p.select(
        F.col("p.id").alias("query_id"), F.col("p.name").alias("query_name"), F.col("p.batchId").alias("batch_id"),
        F.posexplode("p.stateOperators").alias("operator_index", "o"),
    ).select(
        "query_id", "query_name", "batch_id", "operator_index", F.col("o.numRowsTotal").alias("state_rows"),
        F.col("o.numRowsUpdated").alias("state_rows_updated"), F.col("o.memoryUsedBytes").alias("state_bytes"),
    )


def flatten_progress(events: DataFrame) -> DataFrame:
    """One row per batch from progress JSON in ``value`` (and ``gc_ms``); sources and states are summed up."""
    p = events.select(F.from_json("value", PROGRESS_DDL).alias("p"), "gc_ms")

    def phase(name: str) -> Column:
        return F.coalesce(F.try_element_at("p.durationMs", F.lit(name)), F.lit(0))

    def total(array: str, name: str) -> Column:
        sizes = F.transform(array, lambda x: F.coalesce(x[name], F.lit(0)))
        return F.coalesce(F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0))

    return p.select(
        F.col("p.id").alias("query_id"),
        F.col("p.name").alias("query_name"),
        F.col("p.batchId").alias("batch_id"),
        F.col("p.timestamp").alias("batch_timestamp"),
        F.date_format(F.try_to_timestamp("p.timestamp"), "yyyy-MM-dd HH:mm:ss").alias("batch_time"),
        F.col("p.numInputRows").alias("num_input_rows"),
        F.col("p.inputRowsPerSecond").alias("input_rows_per_second"),
        F.col("p.processedRowsPerSecond").alias("processed_rows_per_second"),
        F.col("p.durationMs").alias("duration_ms"),
        *[phase(k).alias(v) for k, v in PHASES.items()],
        F.coalesce(F.try_element_at("p.eventTime", F.lit("watermark")), F.lit("0")).alias("watermark"),
        F.array_join(F.transform("p.sources", lambda x: x["description"]), "; ").alias("source"),
        total("p.sources", "numInputRows").alias("source_rows"),
        F.col("p.sink.description").alias("sink"),
        total("p.stateOperators", "numRowsTotal").alias("state_rows"),
        total("p.stateOperators", "numRowsUpdated").alias("state_rows_updated"),
        total("p.stateOperators", "memoryUsedBytes").alias("state_bytes"),
        "gc_ms",
    )


def progress_flags(progress: DataFrame, blocked_ms: int = BLOCKED_MS, gc_limit: float = GC_LIMIT_PERCENT) -> DataFrame:
    """Total duration, blocked batches and heavy garbage collection.

    Needs ``duration_ms`` (map of phase to milliseconds) and ``gc_ms``. A batch
    without an addBatch phase counts as one millisecond for the GC share.
    """
    add_batch = F.try_element_at("duration_ms", F.lit("addBatch"))
    total = F.aggregate(F.map_values("duration_ms"), F.lit(0).cast("bigint"), lambda a, v: a + v)
    gc_percent = F.round(F.col("gc_ms") * 100.0 / F.greatest(F.coalesce(add_batch, F.lit(1)), F.lit(1)), 2)
    return progress.withColumns({
        "total_duration_ms": total,
        "is_blocked": F.coalesce(add_batch, F.lit(0)) > blocked_ms,
        "gc_percent": gc_percent,
        "gc_warning": gc_percent > gc_limit,
    })


TASK_END = "SparkListenerTaskEnd"
_SHUFFLE_READ = (
    "`Remote Blocks Fetched`:bigint,`Local Blocks Fetched`:bigint,`Fetch Wait Time`:bigint,"
    "`Remote Bytes Read`:bigint,`Local Bytes Read`:bigint,`Total Records Read`:bigint"
)
_SHUFFLE_WRITE = "`Shuffle Bytes Written`:bigint,`Shuffle Write Time`:bigint,`Shuffle Records Written`:bigint"
EVENT_DDL = (
    "Event string, `Stage ID` bigint, `Stage Attempt ID` bigint, `Task Type` string, "
    "`Task Info` struct<`Task ID`:bigint,Host:string,`Executor ID`:string,Speculative:boolean,"
    "Failed:boolean,Killed:boolean,`Launch Time`:bigint,`Finish Time`:bigint>, "
    "`Task Metrics` struct<`Executor Run Time`:bigint,`Executor CPU Time`:bigint,"
    "`Executor Deserialize Time`:bigint,`Executor Deserialize CPU Time`:bigint,`Result Size`:bigint,"
    "`JVM GC Time`:bigint,`Result Serialization Time`:bigint,`Memory Bytes Spilled`:bigint,"
    "`Disk Bytes Spilled`:bigint,`Peak Execution Memory`:bigint,"
    f"`Shuffle Read Metrics`:struct<{_SHUFFLE_READ}>,`Shuffle Write Metrics`:struct<{_SHUFFLE_WRITE}>,"
    "`Input Metrics`:struct<`Bytes Read`:bigint,`Records Read`:bigint>,"
    "`Output Metrics`:struct<`Bytes Written`:bigint,`Records Written`:bigint>>"
)
_TASK_COLUMNS = {
    "stage_id": "`Stage ID`", "stage_attempt": "`Stage Attempt ID`", "task_type": "`Task Type`",
    "task_id": "`Task Info`.`Task ID`", "host": "`Task Info`.Host", "executor_id": "`Task Info`.`Executor ID`",
    "speculative": "`Task Info`.Speculative", "failed": "`Task Info`.Failed", "killed": "`Task Info`.Killed",
    "launch_ms": "`Task Info`.`Launch Time`", "finish_ms": "`Task Info`.`Finish Time`",
    "run_ms": "`Task Metrics`.`Executor Run Time`", "cpu_ns": "`Task Metrics`.`Executor CPU Time`",
    "deserialize_ms": "`Task Metrics`.`Executor Deserialize Time`",
    "result_bytes": "`Task Metrics`.`Result Size`", "gc_ms": "`Task Metrics`.`JVM GC Time`",
    "memory_spilled": "`Task Metrics`.`Memory Bytes Spilled`",
    "disk_spilled": "`Task Metrics`.`Disk Bytes Spilled`",
    "peak_memory": "`Task Metrics`.`Peak Execution Memory`",
    "shuffle_remote_bytes": "`Task Metrics`.`Shuffle Read Metrics`.`Remote Bytes Read`",
    "shuffle_local_bytes": "`Task Metrics`.`Shuffle Read Metrics`.`Local Bytes Read`",
    "shuffle_wait_ms": "`Task Metrics`.`Shuffle Read Metrics`.`Fetch Wait Time`",
    "shuffle_records_read": "`Task Metrics`.`Shuffle Read Metrics`.`Total Records Read`",
    "shuffle_bytes_written": "`Task Metrics`.`Shuffle Write Metrics`.`Shuffle Bytes Written`",
    "shuffle_records_written": "`Task Metrics`.`Shuffle Write Metrics`.`Shuffle Records Written`",
    "input_bytes": "`Task Metrics`.`Input Metrics`.`Bytes Read`",
    "input_records": "`Task Metrics`.`Input Metrics`.`Records Read`",
    "output_bytes": "`Task Metrics`.`Output Metrics`.`Bytes Written`",
    "output_records": "`Task Metrics`.`Output Metrics`.`Records Written`",
}


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def task_metrics(log_lines: DataFrame) -> DataFrame:
    """One row per finished task from event-log lines in ``value``."""
    # the name anywhere in the text keeps the JSON parser off most other events; the parsed field decides
    maybe = log_lines.where(F.col("value").contains(TASK_END))
    rows = pin(maybe, e=F.from_json("value", EVENT_DDL)).where(F.col("e.Event") == TASK_END)
    return rows.select(
        *[F.col(f"e.{path}").alias(name) for name, path in _TASK_COLUMNS.items()]
    ).withColumn("duration_ms", F.col("finish_ms") - F.col("launch_ms"))


def stage_metrics(tasks: DataFrame) -> DataFrame:
    """Task metrics summed up per stage."""
    total = lambda name: F.sum(F.coalesce(name, F.lit(0))).alias(name)
    return tasks.groupBy("stage_id").agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.count_if("failed").alias("n_failed"),
        F.max("duration_ms").alias("longest_ms"),
        *[total(n) for n in (
            "run_ms", "gc_ms", "memory_spilled", "disk_spilled", "shuffle_bytes_written",
            "shuffle_records_read", "input_bytes", "input_records",
        )],
    )


# Gauges that share a whole, per dashboard panel.
RATIO_PANELS = {
    "stage": ("failed_stages", "running_stages", "waiting_stages"),
    "batch": ("running_batches", "waiting_batches", "completed_batches"),
}


def metrics_ratios(snapshots: DataFrame) -> DataFrame:
    """Dashboard ratios in percent, two decimals; zero when the whole is zero."""

    def share(part: str, whole: Column) -> Column:
        percent = F.bround(F.try_divide(F.col(part).cast("double") * 100.0, whole.cast("double")), 2)
        return F.coalesce(percent, F.lit(0.0)).alias(f"{part}_percent")

    out = []
    for gauges in RATIO_PANELS.values():
        whole = F.col(gauges[0]) + F.col(gauges[1]) + F.col(gauges[2])
        out += [share(g, whole) for g in gauges]
    memory = F.col("mem_used_mb") + F.col("remaining_mem_mb")
    out += [share(g, memory) for g in ("mem_used_mb", "remaining_mem_mb", "max_mem_mb")]
    return snapshots.select("snapshot_ms", *out)
