"""Writers: keyed tables that rewrite only the key ranges a change touches, and change tables of streams.

Both are lists of live folders (``manifests``): a failed write leaves the old table,
of two writers at once neither loses a row, and an empty table reads as empty.

A keyed table is cut into buckets by key range. An upsert reads, merges and writes
the buckets that its keys fall into; the files of all others stay as they are.

A change table has levels. Each batch of a stream is a part of level 0; parts of one
level are folded into one of the next when there are enough of them, so a row is
rewritten once per level and a reader opens a number of parts that grows with the
logarithm of the number of batches. A fold names exactly the parts it has read:
what streams write meanwhile stays. A replayed batch replaces itself, and no stream
with a new checkpoint overwrites what an older one wrote.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.latest import newest_per, upsert_latest
from wayfare.sources import manifests
from wayfare.sources.manifests import Conflict, Manifest, Part

RUN, BATCH, WRITTEN = "run", "batch_id", "written_at"
BUCKET = "bucket"
STAGED = "_staged"  # names that begin so are passed over by file readers
#: Key ranges of a new table, and keys that are looked at to choose them (their layout alone depends on these).
BUCKETS = 16
BOUND_KEYS = 10_000
#: Parts of one level that are folded into the next.
FAN = 10


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that is cached for the body, also when the body fails."""
    cached = df.persist()
    try:
        yield cached
    finally:
        cached.unpersist()


@contextmanager
def staged(batch: DataFrame, rows: DataFrame, path: str, batch_id: int) -> Iterator[DataFrame]:
    """Rows made of a micro-batch, written to files below ``path`` for the body; removed after it, also when it fails.

    A cached partition is read whole by one task, and lines are many times as long as
    the columns they are read from; files are read in splits of bounded size. What a
    failed run left is overwritten when its batch is replayed.
    """
    spark, folder = batch.sparkSession, f"{STAGED}/{run_of(batch)}-{batch_id}"
    try:
        rows.write.mode("overwrite").parquet(f"{path}/{folder}")
        yield spark.read.schema(rows.schema).parquet(f"{path}/{folder}")
    finally:
        manifests.Store(spark, path).remove(folder)


def key_text(keys: list[str]) -> Column:
    """The key as one text, in whose order buckets are cut; null if a part is null."""
    return F.concat(*[x for key in keys for x in (F.col(key).cast("string"), F.lit("\x1f"))][:-1])


def _bounds(rows: DataFrame, keys: list[str], buckets: int) -> tuple[str, ...]:
    """Cuts between key ranges of about equal size, from a bounded number of keys picked by hash."""
    text = key_text(keys)
    picked = rows.select(text.alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(BOUND_KEYS)
    known = sorted(r["k"] for r in picked.toLocalIterator())
    if not known:
        return ()
    cuts = {known[len(known) * n // buckets] for n in range(1, buckets)}
    return tuple(sorted(cuts - {known[0]}))


def bucket_of(keys: list[str], bounds: tuple[str, ...]) -> Column:
    """Number of the key range of a row."""
    if not bounds:
        return F.lit(0)
    text = key_text(keys)
    return F.size(F.filter(F.lit(list(bounds)), lambda first: first <= text))


def _write_buckets(rows: DataFrame, path: str, buckets: Column) -> list[Part]:
    """Writes rows by bucket; returns the parts of the buckets that have rows."""
    folder = manifests.new_folder()
    placed = rows.withColumn(BUCKET, buckets).hint("rebalance", F.col(BUCKET))
    placed.write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    names = manifests.Store(rows.sparkSession, path).names(folder)
    return [Part(f"{folder}/{n}", bucket=int(n.split("=")[1])) for n in names if n.startswith(f"{BUCKET}=")]


def write_report(report: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Replace a table by a report; rows without a key are skipped. Readers change over when it is whole."""
    rows = report.where(F.col(key).isNotNull())
    bounds = _bounds(rows, [key], buckets)
    parts = _write_buckets(rows, path, bucket_of([key], bounds))
    columns = manifests.columns_of(report)
    manifests.commit(report.sparkSession, path, lambda now: Manifest(0, columns, tuple(parts), bounds))


def upsert_report(report: DataFrame, path: str, keys: list[str], version: list[str], buckets: int = BUCKETS) -> None:
    """Merge a report into its table by key: rows of other keys stay, of equal keys the newest by ``version`` stays.

    The table is made by the first write. Rows without a key are skipped, and a
    key has one row. Where another writer changed the same key ranges meanwhile, the
    merge is done again on what it made.
    """
    _change(report, path, keys, buckets, lambda stored, rows: upsert_latest(stored, rows, keys, version))


def replace_range(rows: DataFrame, path: str, keys: list[str], low: str, high: str, buckets: int = BUCKETS) -> None:
    """Replace the rows whose key text is in [low, high) by the given ones of that range; all others stay as they are."""
    text = key_text(keys)
    inside = (text >= low) & (text < high)
    _change(rows.where(inside), path, keys, buckets, lambda stored, fresh: stored.where(~inside).unionByName(fresh), (low, high))


def _change(
    report: DataFrame, path: str, keys: list[str], buckets: int, merge: Callable[[DataFrame, DataFrame], DataFrame], span: tuple[str, str] | None = None
) -> None:
    """Rewrites the buckets that the rows (and the span of keys) fall into, as ``merge`` makes them of what is stored."""
    spark = report.sparkSession
    with kept(report.where(key_text(keys).isNotNull())) as changes:
        while True:
            base = manifests.newest(spark, path)
            # an empty table has no ranges worth keeping
            bounds = base.bounds if base and base.parts else _bounds(changes, keys, buckets)
            columns = base.columns if base else manifests.columns_of(report)
            place = bucket_of(keys, bounds)
            touched = {r[0] for r in changes.select(place.alias(BUCKET)).distinct().toLocalIterator()}  # at most one row per bucket
            if span:
                touched |= set(range(bisect_right(bounds, span[0]), bisect_left(bounds, span[1]) + 1))
            old = [p for p in base.parts if p.bucket in touched] if base else []
            stored = changes.limit(0) if base is None else manifests.read_parts(spark, path, base, old)
            parts = _write_buckets(merge(stored, changes), path, place)

            def edit(now: Manifest | None) -> Manifest:
                found = {p for p in now.parts if p.bucket in touched} if now else set()
                if found != set(old) or (now and now.parts and now.bounds != bounds) or (now and now.columns != columns):
                    raise Conflict
                rest = [p for p in now.parts if p.bucket not in touched] if now else []
                return Manifest(0, columns, (*rest, *parts), bounds)

            try:
                manifests.commit(spark, path, edit)
                return
            except Conflict:
                manifests.discard(spark, path, parts)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    stored = manifests.newest(spark, path)
    if stored is None:
        raise FileNotFoundError(path)
    return manifests.read_parts(spark, path, stored)


def write_history(df: DataFrame, path: str, ts: str, mode: str = "overwrite") -> None:
    """Write facts in month folders, sorted by time inside.

    Period reports then open only the folders of their months, and skip row
    groups by time. Range partitioning on (month, time) spreads a busy month
    over many tasks and lets a task write few folders.
    """
    dated = df.withColumn("month", F.date_format(ts, "yyyy-MM"))
    placed = dated.repartitionByRange("month", ts).sortWithinPartitions("month", ts)
    placed.write.mode(mode).partitionBy("month").parquet(path)


def run_of(batch: DataFrame) -> str:
    """The identity of the stream that a micro-batch belongs to, as its checkpoint keeps it."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise ValueError("not inside a streaming batch; name the run")
    return run


def append_changes(batch: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    """Add one micro-batch to a change table; a replayed batch replaces itself, or is in a fold already and adds nothing."""
    spark, run = batch.sparkSession, run or run_of(batch)
    rows = batch.withColumns({WRITTEN: F.current_timestamp(), RUN: F.lit(run), BATCH: F.lit(batch_id).cast("bigint")})
    part = Part(manifests.new_folder(), level=0, run=run, batch=batch_id)
    rows.write.parquet(f"{path}/{part.folder}")
    columns = manifests.columns_of(rows)

    def edit(now: Manifest | None) -> Manifest:
        if now is None:
            return Manifest(0, columns, (part,), runs={run: batch_id})
        others = tuple(p for p in now.parts if (p.run, p.batch) != (run, batch_id))
        if len(others) == len(now.parts) and now.runs.get(run, -1) >= batch_id:
            raise Conflict
        return replace(now, parts=(*others, part), runs=now.runs | {run: max(batch_id, now.runs.get(run, -1))})

    try:
        manifests.commit(spark, path, edit)
    except Conflict:
        manifests.discard(spark, path, [part])


def _changes(spark: SparkSession, path: str) -> Manifest:
    now = manifests.newest(spark, path)
    if now is None:
        raise FileNotFoundError(path)
    return now


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All live parts: every key's newest image is among them, maybe more than once."""
    return manifests.read_parts(spark, path, _changes(spark, path))


def read_current(spark: SparkSession, path: str, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Newest image of every key of a change table: by ``order``, then by time of writing and batch."""
    images = _current(read_changes(spark, path), keys, order)
    return images.drop(RUN, BATCH, WRITTEN)


def _current(changes: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    by = [*(order or []), WRITTEN, BATCH]
    values = [c for c in changes.columns if c not in keys]
    return newest_per(changes, keys, by, values).select(*changes.columns)


def fold(spark: SparkSession, path: str, now: Manifest, parts: list[Part], level: int, keys: list[str] | None, order: list[str] | None) -> bool:
    """Replaces some parts by one of a level: the newest images of their keys, or without keys all rows.

    False if one of the parts was folded or replaced by someone else meanwhile; then nothing changes.
    """
    rows = manifests.read_parts(spark, path, now, parts)
    folded = Part(manifests.new_folder(), level=level)
    (_current(rows, keys, order) if keys else rows).hint("rebalance").write.parquet(f"{path}/{folded.folder}")
    gone = set(parts)

    def edit(then: Manifest | None) -> Manifest:
        if then is None or not gone <= set(then.parts):
            raise Conflict
        return replace(then, parts=(*(p for p in then.parts if p not in gone), folded))

    try:
        manifests.commit(spark, path, edit)
        return True
    except Conflict:
        manifests.discard(spark, path, [folded])
        return False


def fold_levels(spark: SparkSession, path: str, keys: list[str] | None = None, order: list[str] | None = None, fan: int = FAN) -> None:
    """Folds each level that holds ``fan`` parts or more (two at least) into the next."""
    level = 0
    while True:
        now = _changes(spark, path)
        parts = [p for p in now.parts if p.level == level]
        if len(parts) >= max(2, fan):
            fold(spark, path, now, parts, level + 1, keys, order)
        elif level >= max((p.level or 0 for p in now.parts), default=0):
            return
        level += 1


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str] | None = None) -> None:
    """Folds all parts into one: the newest image of every key. Streams may go on writing; what they add meanwhile stays."""
    now = _changes(spark, path)
    top = 1 + max((p.level or 0 for p in now.parts), default=0)
    fold(spark, path, now, list(now.parts), top, keys, order)
