"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import inspect
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import wayfare
from wayfare.session import scratch_path

#: White space that separates words in every operator: blank and U+0009 to U+000D.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Gives the workers this library's code, once per application; an installed library needs no such call."""
    context = spark.sparkContext
    if getattr(context, "_wayfare_shipped", None) == context.applicationId:
        return
    root = Path(wayfare.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="wayfare-code-")) / "wayfare-code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"wayfare/{file.relative_to(root)}")
    context.addPyFile(str(archive))
    context._wayfare_shipped = context.applicationId


def text_of(column: str = "text") -> Column:
    """A text column in which null is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs of other characters than white space."""
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")


def is_held_out(doc_id: Column) -> Column:
    """True for the third of the rows that models never learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage and outlives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Removes what ``stored`` wrote for these frames; nothing may read them afterwards."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hand_back() -> None:
    """Gives a worker's free memory back to the system: workers stay for later tasks and would hold on to it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass


def hands_back(work: Callable) -> Callable:
    """A function over batches, or over one group, that gives memory back at its end."""
    n_parts = len(inspect.signature(work).parameters)
    if inspect.isgeneratorfunction(work):
        def run(batches):
            yield from work(batches)
            hand_back()
    elif n_parts == 1:
        def run(group):
            out = work(group)
            hand_back()
            return out
    else:
        def run(left, right):
            out = work(left, right)
            hand_back()
            return out
    return run


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores put in front until no column has it (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts, for sizing the partitions of later shuffles."""
    row = docs.agg(F.sum(F.octet_length(F.col(column))).alias("n")).first()
    return int(row.n or 0)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that their order looks random."""
    out = values.astype(np.uint64, copy=True)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def packed_numbers(values: np.ndarray, width: int) -> bytes:
    """Non-negative numbers of ``width`` bytes, byte planes apart: planes of zeros nearly vanish when a shuffle is compressed."""
    return np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def unpacked_numbers(data: bytes, width: int, count: int, at: int = 0) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, width * count, at).reshape(width, count)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


Query = Callable[[SparkSession, str], DataFrame]
