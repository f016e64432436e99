"""Keyed tables and change tables: what a change rewrites, writers at the same time, folds, bounded listings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayfare.session import scratch_path
from wayfare.sources import manifests, ranges, readers, sinks
from wayfare.sources.files import Store


def _rows_of(spark, *values):
    return spark.createDataFrame(list(values), "id string, day string, v int")


def _files(spark, path):
    return {f.path: f.modificationTime for f in spark.read.format("binaryFile").load(path).select("path", "modificationTime").collect()}


def _live(spark, path):
    now = manifests.newest(spark, path)
    return {p.bucket: _files(spark, f"{path}/{p.folder}/*.parquet") for p in now.parts}


def _table(spark, label, n=400):
    path = scratch_path(spark, label)
    sinks.upsert_report(spark.range(n).selectExpr("format_string('k%03d', id) as id", "'1' as day", "cast(id as int) as v"), path, ["id"], ["day"], buckets=8)
    return path


def test_an_upsert_rewrites_the_touched_range_only(spark):
    path = _table(spark, "ranges")
    before = _live(spark, path)
    assert len(before) == 8
    sinks.upsert_report(_rows_of(spark, ("k123", "2", -1), (None, "2", -2)), path, ["id"], ["day"])
    after = _live(spark, path)
    touched = {b for b in before if before[b] != after[b]}
    assert len(touched) == 1 and set(before) == set(after)
    got = sinks.read_report(spark, path)
    assert got.count() == 400 and rows(got.where("id = 'k123'")) == [("k123", "2", -1)]
    # an older row of a key changes nothing, a new key is added to its range
    sinks.upsert_report(_rows_of(spark, ("k123", "1", 7), ("k123a", "1", 8)), path, ["id"], ["day"])
    assert rows(sinks.read_report(spark, path).where("id like 'k123%'")) == [("k123", "2", -1), ("k123a", "1", 8)]


def test_ranges_hold_about_as_many_keys(spark):
    path = _table(spark, "even", 2000)
    now = manifests.newest(spark, path)
    sizes = [manifests.read_parts(spark, path, now, [p]).count() for p in now.parts]
    assert sum(sizes) == 2000 and max(sizes) < 2 * min(sizes)


def test_keys_of_several_columns_and_of_one_value(spark):
    path = scratch_path(spark, "pairs")
    for day, v in (("1", 1), ("2", 2), ("1", 3)):
        sinks.upsert_report(_rows_of(spark, ("a", day, v), ("b", day, v)), path, ["id", "day"], ["v"])
    assert rows(sinks.read_report(spark, path)) == [("a", "1", 3), ("a", "2", 2), ("b", "1", 3), ("b", "2", 2)]
    one = scratch_path(spark, "one")
    sinks.write_report(_rows_of(spark, *[("same", "1", i) for i in range(50)]), one, "id")
    assert sinks.read_report(spark, one).count() == 50 and len(_live(spark, one)) == 1


def test_an_empty_report_is_empty(spark):
    path = scratch_path(spark, "empty")
    sinks.write_report(_rows_of(spark, ("a", "1", 1), ("b", "1", 2)), path, "id")
    sinks.write_report(_rows_of(spark, ("a", "1", 1)).limit(0), path, "id")
    assert sinks.read_report(spark, path).collect() == []
    assert sinks.read_report(spark, path).schema == _rows_of(spark, ("a", "1", 1)).schema
    sinks.upsert_report(_rows_of(spark, ("c", "2", 3)), path, ["id"], ["day"])
    assert rows(sinks.read_report(spark, path)) == [("c", "2", 3)]
    with pytest.raises(FileNotFoundError):
        sinks.read_report(spark, scratch_path(spark, "nothing"))


@pytest.mark.parametrize("key, other", [("k010", "k390"), ("k010", "k010"), ("k010", "k011")])
def test_two_writers_lose_nothing(spark, monkeypatch, key, other):
    """The second writer comes between the first one's reading and its commit: in another range, at the same key, in the same range."""
    path = _table(spark, "writers")
    commit, turns = manifests.commit, []

    def interrupted(session, at, edit):
        turns.append(at)
        if len(turns) == 1:
            sinks.upsert_report(_rows_of(spark, (other, "3", 30)), path, ["id"], ["day"])
        return commit(session, at, edit)

    monkeypatch.setattr(manifests, "commit", interrupted)
    sinks.upsert_report(_rows_of(spark, (key, "2", 20)), path, ["id"], ["day"])
    got = {r["id"]: r["v"] for r in sinks.read_report(spark, path).collect()}
    assert len(got) == 400 and got[other] == 30 and got[key] == (30 if key == other else 20)
    assert len(turns) == (2 if (key, other) == ("k010", "k390") else 3)  # disjoint ranges need no second merge


def test_a_number_is_taken_once(spark):
    store = Store(spark, scratch_path(spark, "store"))
    assert store.publish("manifests/1.json", "first") and not store.publish("manifests/1.json", "second")
    assert store.read("manifests/1.json") == "first" and store.names("manifests") == ["1.json"] and store.names("no") == []


def test_a_batch_written_during_a_fold_stays(spark, monkeypatch):
    path = scratch_path(spark, "race")
    sinks.append_changes(_rows_of(spark, ("a", "1", 1)), path, 0, "x")
    sinks.append_changes(_rows_of(spark, ("b", "1", 2), ("a", "2", 5)), path, 1, "x")
    read = manifests.read_parts

    def late(*args, **kwargs):
        monkeypatch.setattr(manifests, "read_parts", read)
        sinks.append_changes(_rows_of(spark, ("c", "1", 3)), path, 0, "y")
        return read(*args, **kwargs)

    monkeypatch.setattr(manifests, "read_parts", late)
    sinks.compact(spark, path, ["id"], ["day"])
    assert rows(sinks.read_current(spark, path, ["id"], ["day"])) == [("a", "2", 5), ("b", "1", 2), ("c", "1", 3)]
    assert sorted(p.level for p in manifests.newest(spark, path).parts) == [0, 1]


def test_two_folds_at_once_lose_nothing(spark, monkeypatch):
    path = scratch_path(spark, "folds")
    for batch in range(4):
        sinks.append_changes(_rows_of(spark, (f"k{batch}", "1", batch)), path, batch, "x")
    read = manifests.read_parts

    def late(*args, **kwargs):
        monkeypatch.setattr(manifests, "read_parts", read)
        sinks.compact(spark, path, ["id"])
        return read(*args, **kwargs)

    monkeypatch.setattr(manifests, "read_parts", late)
    now = manifests.newest(spark, path)
    assert not sinks.fold(spark, path, now, list(now.parts), 1, ["id"], None)
    assert sinks.read_current(spark, path, ["id"]).count() == 4 and len(manifests.newest(spark, path).parts) == 1


def test_levels_of_many_batches(spark):
    path = scratch_path(spark, "levels")
    for batch in range(40):
        sinks.append_changes(_rows_of(spark, ("hot", "1", batch), (f"k{batch % 7}", "1", batch)).coalesce(1), path, batch, "x")
        sinks.fold_levels(spark, path, ["id"], fan=3)
    now = manifests.newest(spark, path)
    assert len(now.parts) <= 2 * 4  # two parts at each of the levels of 1, 3, 9 and 27 batches
    assert max(p.level for p in now.parts) == 3
    want = [("hot", "1", 39), *(("k%d" % k, "1", max(b for b in range(40) if b % 7 == k)) for k in range(7))]
    assert rows(sinks.read_current(spark, path, ["id"])) == sorted(want)
    # a batch that is in a fold already is not added again when it is replayed
    sinks.append_changes(_rows_of(spark, ("hot", "1", 0)), path, 0, "x")
    assert manifests.newest(spark, path).version == now.version
    store = Store(spark, path)
    assert len(store.names(manifests.MANIFESTS)) <= manifests.KEPT and len(store.names("data")) <= 8 + 2 * manifests.KEPT


def test_tables_without_keys_keep_all_rows(spark):
    path = scratch_path(spark, "plain")
    for batch in range(7):
        sinks.append_changes(_rows_of(spark, ("a", "1", batch)), path, batch, "x")
        sinks.fold_levels(spark, path, fan=3)
    assert [r["v"] for r in sinks.read_changes(spark, path).orderBy("v").collect()] == list(range(7))
    assert len(manifests.newest(spark, path).parts) == 3


def test_ten_thousand_batches_stay_listed_in_a_few_parts(spark):
    """Manifests alone, with no files behind the parts: the list and the folder of manifests stay short."""
    path = scratch_path(spark, "long")
    columns, fan = manifests.columns_of(_rows_of(spark, ("a", "1", 1))), 10
    longest = 0
    now = manifests.commit(spark, path, lambda _: manifests.Manifest(0, columns))
    parts: list[manifests.Part] = []
    for batch in range(10_000):
        parts.append(manifests.Part(f"data/{batch}", level=0, run="x", batch=batch))
        level = 0
        while len(full := [p for p in parts if p.level == level]) >= fan:
            parts = [p for p in parts if p.level != level] + [manifests.Part(f"data/{batch}-{level}", level=level + 1)]
            level += 1
        assert full is not None
        longest = max(longest, len(parts))
        if batch % 100 == 99:  # one of so many is published, to keep the test short
            now = manifests.commit(spark, path, lambda _, p=tuple(parts): manifests.Manifest(0, columns, p))
    assert longest <= 4 * (fan - 1) + 1 and now.version == 100
    assert len(Store(spark, path).names(manifests.MANIFESTS)) == manifests.KEPT


def test_rows_of_a_part_know_their_batch(spark):
    path = scratch_path(spark, "batches")
    sinks.append_changes(_rows_of(spark, ("a", "1", 1)), path, 4, "x")
    row = sinks.read_changes(spark, path).select(sinks.RUN, sinks.BATCH, F.col(sinks.WRITTEN).isNotNull().alias("known")).first()
    assert tuple(row) == ("x", 4, True)


def _ranged(spark, n=500):
    path = scratch_path(spark, "key-ranges")
    frame = spark.range(n).selectExpr("format_string('%04d', id) as k", "id as v", "timestamp_seconds(id) as t")
    sinks.write_report(frame.unionByName(frame.limit(1).selectExpr("cast(null as string) as k", "v", "t")), path, "k", buckets=10)
    return path, frame


@pytest.mark.parametrize("start, stop", [(None, None), ("0100", "0200"), ("0123", "0124"), ("0490", None), (None, "0003"), ("0600", None), ("0200", "0100"), ("", "")])
def test_one_partition_per_key_range(spark, start, stop):
    path, frame = _ranged(spark)
    now = manifests.newest(spark, path)
    got = ranges.read_key_range(spark, path, "k", start, stop)
    want = readers.scan_key_range(frame, "k", start, stop) if (start, stop) != ("", "") else frame.limit(0)
    if start is not None and stop is not None and stop <= start:
        want = frame.limit(0)
    assert rows(got) == rows(want) and got.dtypes == frame.dtypes
    if got.count():
        edges = ["", *now.bounds, "~"]
        overlap = sum(low < (stop or "~") and (start or "") < high for low, high in zip(edges, edges[1:]))
        assert len(now.parts) == 10 and got.rdd.getNumPartitions() == overlap
        assert got.select(F.spark_partition_id()).distinct().count() <= overlap


def test_key_ranges_of_no_table(spark):
    with pytest.raises(FileNotFoundError):
        ranges.read_key_range(spark, scratch_path(spark, "nothing"), "k")
    path = scratch_path(spark, "none")
    sinks.write_report(spark.createDataFrame([], "k string, v int"), path, "k")
    assert ranges.read_key_range(spark, path, "k", "a", "b").collect() == []
