"""Versions of the canonical table and compaction of logs: readers see one version, appended rows stay."""
import datetime as dt
import os
import tempfile

import pytest

from conftest import make_events
from ebbline.sources import registry as REG
from ebbline.sources import versions as V
from ebbline.sources.canonical import publish_events, read_events, write_events


def events(spark, user, n):
    return make_events(spark, [dict(event_id=i, userId=user, ts=f"2024-01-0{1 + i % 3} 00:00:0{i}") for i in range(n)])


def test_reader_during_a_rewrite_sees_one_version(spark):
    path = f"{tempfile.mkdtemp()}/events"
    publish_events(events(spark, "a", 4), path)
    open_reader = read_events(spark, path)

    class Failed(Exception):
        pass

    def fail(folder):
        write_events(events(spark, "b", 2), folder)
        # the new folder is full, but nothing is published yet
        assert {r.userId for r in read_events(spark, path).collect()} == {"a"}
        raise Failed

    with pytest.raises(Failed):
        V.publish(spark, path, fail)
    assert read_events(spark, path).count() == 4
    publish_events(events(spark, "c", 3), path)
    assert open_reader.count() == 4 and {r.userId for r in open_reader.collect()} == {"a"}
    assert [(r.userId, r.event_id) for r in read_events(spark, path).orderBy("event_id").collect()] == [("c", i) for i in range(3)]
    publish_events(events(spark, "d", 1), path)
    V.drop_old_versions(spark, path, keep=1)
    assert len(V.manifests(spark, path)) == 1 and read_events(spark, path).count() == 1


def test_a_plain_table_is_not_overwritten(spark):
    path = f"{tempfile.mkdtemp()}/plain"
    write_events(events(spark, "a", 2), path)
    with pytest.raises(FileExistsError):
        write_events(events(spark, "b", 2), path)
    assert {r.userId for r in read_events(spark, path).collect()} == {"a"}


def entry(spark, i):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), f"m{i}", False, 0.1, False, None)], REG.MONITOR_LOG_SCHEMA)


def test_log_is_compacted_while_rows_are_appended(spark):
    path = f"{tempfile.mkdtemp()}/log"
    ids = lambda: sorted(r.monitoring_id for r in REG.read_monitor_log(spark, path, 1000).collect())
    REG.compact(spark, path, REG.MONITOR_LOG_SCHEMA)      # nothing there yet
    assert ids() == []
    for i in range(5):
        REG.sink_monitor_log(entry(spark, i), path)
    paths = V.log_paths(spark, path)
    # a row is appended after the files to compact were chosen
    REG.sink_monitor_log(entry(spark, 5), path)
    names = [p.rsplit("/", 1)[-1] for p in paths]
    V.publish(spark, path, lambda folder: REG._read(spark, paths, REG.MONITOR_LOG_SCHEMA).coalesce(1).write.parquet(folder), names)
    want = [f"m{i}" for i in range(6)]
    assert ids() == want
    REG.compact(spark, path, REG.MONITOR_LOG_SCHEMA)
    assert ids() == want and len(V.log_paths(spark, path)) == 1
    REG.sink_monitor_log(entry(spark, 6), path)
    assert ids() == [*want, "m6"]
    REG.compact(spark, path, REG.MONITOR_LOG_SCHEMA)
    V.drop_old_versions(spark, path, keep=1)
    assert ids() == [*want, "m6"]
    assert [f for f in os.listdir(path) if f.endswith(".parquet")] == []
