"""Stored tables: history with a manifest, versioned state snapshots."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sensorstream.functions import parse_readings
from sensorstream.plans.catalog import q_recent_alerts, q_recent_window
from sensorstream.session import scratch_path
from sensorstream.sources import append_history, history_count, history_end, history_stream, read_history, recent_history
from sensorstream.sources.readers import MESSAGE_SCHEMA
from sensorstream.streaming import current_state, latest_state_stream, refresh_state, snapshots

from paths import SF_SMALL

NOW = {"availableNow": True}
SCHEMA = "event_id long, sensor_id string, event_time timestamp_ntz, temperature double"


def _messages(spark, path, rows):
    msgs = [(i, json.dumps({"sensor_id": s, "timestamp": t, "temperature": v})) for i, s, t, v in rows]
    spark.createDataFrame(msgs, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("query", [q_recent_window, q_recent_alerts])
def test_horizon_needs_no_scan_and_no_parse(spark, query):
    plan = query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "scalar-subquery" not in plan.lower() and "Subquery" not in plan
    assert plan.count("FileScan") == 1 and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_recent_history_equals_a_plain_filter(spark):
    t = dt.datetime(2024, 3, 5, 11)
    rows = [(k, f"sensor_{k % 3 + 1}", t - dt.timedelta(minutes=37 * k), float(k)) for k in range(90)]
    rows += [(200, "unknown", t + dt.timedelta(days=9), 1.0), (201, None, t, 1.0), (202, "sensor_1", None, 1.0), (203, "sensor_2", t - dt.timedelta(hours=12), 1.0)]
    root = scratch_path(spark, "history")
    frame = spark.createDataFrame(rows, SCHEMA)
    append_history(frame.where("event_id % 2 = 0"), root)
    append_history(frame.where("event_id % 2 = 1"), root)
    append_history(frame.limit(0), root)
    assert history_end(spark, root) == t and history_count(spark, root) == len(rows)
    got = sorted(r["event_id"] for r in recent_history(spark, root).collect())
    assert got == sorted(k for k, s, at, _ in rows if s and s.startswith("sensor") and at and at >= t - dt.timedelta(hours=12))
    assert recent_history(spark, root, as_of=t - dt.timedelta(days=30)).count() == sum(1 for _, s, at, _ in rows if s and s.startswith("sensor") and at)
    assert recent_history(spark, root, sensors=["nobody"]).count() == 0


def test_history_stream_replays_an_epoch_in_place(spark):
    src, root, ck = scratch_path(spark, "src"), scratch_path(spark, "history"), scratch_path(spark, "ck")
    for k in range(3):
        _messages(spark, src, [(k, "sensor_1", f"2024-01-0{k + 1}T00:00:00", 20.0), (10 + k, "sensor_2", "bad", 1.0)])

    def run():
        stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
        history_stream(parse_readings(stream, keep=("event_id",)), root, ck, NOW).awaitTermination()

    run()
    os.remove(f"{ck}/commits/2")  # as if the query had stopped after its write
    crc = f"{ck}/commits/.2.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run()
    assert read_history(spark, root).count() == history_count(spark, root) == 6
    assert history_end(spark, root) == dt.datetime(2024, 1, 3)


def _feed(spark, src, log, ck, rows):
    _messages(spark, src, rows)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(src)
    latest_state_stream(parse_readings(stream, keep=("event_id",)), log, ck, NOW).awaitTermination()


def _ids(frame):
    return {r["sensor_id"]: r["event_id"] for r in frame.collect()}


def test_refresh_crash_and_refresh(spark, monkeypatch):
    src, log, ck = (scratch_path(spark, n) for n in ("src", "log", "ck"))
    snaps = scratch_path(spark, "snaps")
    _feed(spark, src, log, ck, [(1, "sensor_1", "2024-01-01T00:00:00", 1.0), (2, "sensor_2", "2024-01-05T00:00:00", 1.0)])
    assert _ids(refresh_state(spark, log, snaps)) == {"sensor_1": 1, "sensor_2": 2}
    _feed(spark, src, log, ck, [(3, "sensor_1", "2024-01-02T00:00:00", 1.0), (4, "sensor_2", "2024-01-02T00:00:00", 1.0)])
    # stops after the data, before the pointer: the version does not exist
    with monkeypatch.context() as m:
        m.setattr(snapshots._Files, "make_empty", lambda self, path: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            refresh_state(spark, log, snaps)
    want = {"sensor_1": 3, "sensor_2": 2}
    assert snapshots.versions(spark, snaps) == [0] and _ids(current_state(spark, log, snaps)) == want
    assert _ids(refresh_state(spark, log, snaps)) == want and snapshots.versions(spark, snaps) == [0, 1]


def test_folders_stay_bounded_and_readers_keep_their_version(spark):
    src, log, ck = (scratch_path(spark, n) for n in ("src", "log", "ck"))
    snaps, want, reader = scratch_path(spark, "snaps"), {}, None
    for k in range(5):
        _feed(spark, src, log, ck, [(k, "sensor_1", f"2024-01-0{k + 1}T00:00:00", 1.0), (100 - k, f"sensor_{k % 2 + 2}", f"2024-02-0{9 - k}T00:00:00", 1.0)])
        want["sensor_1"] = k
        want.setdefault(f"sensor_{k % 2 + 2}", 100 - k)
        before = dict(want)
        assert _ids(current_state(spark, log, snaps)) == want == _ids(refresh_state(spark, log, snaps, keep=2))
        if reader is not None:  # opened one refresh ago, read now
            assert _ids(reader[0]) == reader[1]
        reader = current_state(spark, log, snaps), before
        assert len(snapshots.versions(spark, snaps)) <= 2 and len(os.listdir(f"{snaps}/data")) <= 2
        assert sum(map(len, snapshots.epochs(spark, log).values())) <= 3
    # an epoch that is still being written is not folded
    run = next(r for r in snapshots.epochs(spark, log) if r != "none")
    spark.read.parquet(f"{snaps}/data/v=4").withColumn("event_id", F.lit(999).cast("long")).withColumn("event_time", F.lit("2025-01-01").cast("timestamp_ntz")).write.parquet(f"{log}/run={run}/epoch=77")
    os.remove(f"{log}/run={run}/epoch=77/_SUCCESS")
    assert _ids(refresh_state(spark, log, snaps)) == want
