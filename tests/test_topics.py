"""Record logs followed by offsets: order, start, rate, restarts, lost records, writers at the same time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayfare.session import scratch_path
from wayfare.sources import manifests, topics


def _records(spark, first, last):
    return spark.range(first, last).selectExpr("concat('r', id) as value", "cast(id % 3 as int) as part", "id")


def _log(spark, label):
    path = scratch_path(spark, label)
    for first, last in ((0, 30), (30, 45), (45, 100)):
        topics.append_records(_records(spark, first, last), path, "part", ["id"])
    return path


def _read(spark, path, out, **options):
    """Runs until all records are there; returns the rows of every batch."""
    batches = {}
    stream = topics.stream_records(spark, path, **options)

    def write(batch, batch_id):
        batches[batch_id] = [tuple(r) for r in batch.select("partition", "offset", "value").collect()]

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", out).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [b for _, b in sorted(batches.items()) if b]


def _want(first=0, last=100):
    return sorted((i % 3, i // 3, f"r{i}") for i in range(first, last))


def test_every_record_once_with_its_offset(spark):
    path, out = _log(spark, "log"), scratch_path(spark, "checkpoint")
    got = _read(spark, path, out)
    assert sorted(r for b in got for r in b) == _want()
    # what is appended later is read by a restarted query, and nothing twice
    topics.append_records(_records(spark, 100, 130), path, "part", ["id"])
    assert sorted(r for b in _read(spark, path, out) for r in b) == _want(100, 130)


def test_a_batch_has_so_many_records_at_most(spark):
    got = _read(spark, _log(spark, "capped"), scratch_path(spark, "checkpoint"), max_offsets=17)
    assert sorted(r for b in got for r in b) == _want()
    assert [len(b) for b in got] == [17] * 5 + [15]


@pytest.mark.parametrize("starting, want", [("latest", []), ('{"0": 30, "1": 33, "2": 33}', [(0, 30, "r90"), (0, 31, "r93"), (0, 32, "r96"), (0, 33, "r99")])])
def test_starting_offsets(spark, starting, want):
    got = _read(spark, _log(spark, "starting"), scratch_path(spark, "checkpoint"), starting=starting)
    assert sorted(r for b in got for r in b) == want


def test_lost_records_fail_the_stream_or_are_passed_over(spark):
    path = _log(spark, "lost")
    topics.drop_records(spark, path, {0: 12, 1: 5})
    assert manifests.newest(spark, path).runs == {"0": 34, "1": 33, "2": 33}
    with pytest.raises(Exception, match="are gone"):
        _read(spark, path, scratch_path(spark, "checkpoint"), starting='{"0": 0, "1": 0, "2": 0}')
    there = [r for r in _want() if r[0] != 0 or r[1] >= 10]  # a file goes when all its records are before the offset
    got = _read(spark, path, scratch_path(spark, "checkpoint"), starting='{"0": 0, "1": 0, "2": 0}', fail_on_loss=False)
    assert sorted(r for b in got for r in b) == there
    assert sorted(r for b in _read(spark, path, scratch_path(spark, "checkpoint")) for r in b) == there  # earliest that is there


def test_two_writers_get_ranges_one_after_the_other(spark, monkeypatch):
    path, commit, turns = scratch_path(spark, "writers"), manifests.commit, []

    def interrupted(session, at, edit):
        turns.append(at)
        if len(turns) == 1:
            topics.append_records(_records(spark, 30, 60), path, "part", ["id"])
        return commit(session, at, edit)

    monkeypatch.setattr(manifests, "commit", interrupted)
    topics.append_records(_records(spark, 0, 30), path, "part", ["id"])
    got = sorted(r for b in _read(spark, path, scratch_path(spark, "checkpoint")) for r in b)
    assert [(p, o) for p, o, _ in got] == [(p, o) for p in range(3) for o in range(20)]
    assert sorted(v for *_, v in got) == sorted(f"r{i}" for i in range(60))


def test_no_log_and_null_partitions(spark):
    path = scratch_path(spark, "none")
    with pytest.raises(FileNotFoundError):
        topics.stream_records(spark, path)
    topics.append_records(_records(spark, 0, 4).withColumn("part", F.lit(None).cast("int")), path, "part", ["id"])
    assert rows(spark.createDataFrame(_read(spark, path, scratch_path(spark, "checkpoint"))[0])) == [(0, i, f"r{i}") for i in range(4)]
