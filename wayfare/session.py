"""Session helper and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning stays on: it sizes shuffles, splits skewed join partitions
# (also where that costs one more exchange) and broadcasts only measured sides.
CLUSTER_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # call sites of every column cost more to record than most plans take to build
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # trip and order state never expires by default, so it must not live on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


TARGET_PARTITION_BYTES = 256 << 20


def sizing_conf(input_bytes: int, max_partitions: int | None = None) -> dict[str, str]:
    """Shuffle settings for a job that reads so many bytes.

    Shuffles start with one partition per 256 MB of input, so that each fits in
    executor memory, and AQE merges the ones that turn out small; 100 TB start
    with about 400,000 partitions. ``max_partitions`` bounds their number for a
    small driver, at the price of larger ones.
    """
    wanted = max(200, -(-input_bytes // TARGET_PARTITION_BYTES))
    if max_partitions:
        wanted = min(wanted, max_partitions)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }


def build_session(app_name: str, master: str | None = None, input_bytes: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = sizing_conf(input_bytes) if input_bytes else {}
    for key, value in {**CLUSTER_CONF, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A folder is made up only for a local master (tests); on a cluster a
    machine-local path would lose data with its machine, so that is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    made = tempfile.mkdtemp(prefix="wayfare-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one written table or checkpoint."""
    return f"{shared_folder(spark)}/wayfare/{label}-{uuid.uuid4().hex}"
