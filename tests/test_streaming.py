"""Streams equal batch; a failed batch is replayed from the checkpoint."""

import pytest
from pyspark.sql import functions as F

from sensorstream.functions import parse_readings
from sensorstream.operators import latest_per_sensor
from sensorstream.session import scratch_path
from sensorstream.sources import for_each_batch, raw_messages
from sensorstream.sources.readers import MESSAGE_SCHEMA
from sensorstream.streaming import latest_state_stream, read_latest_state

from paths import SF_SMALL


def _split_messages(spark, parts=3):
    """Write the sf0.001 messages as several files in event order."""
    msgs = raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    src = scratch_path(spark, "src")
    for k in range(parts):
        msgs.filter(F.col("event_id") % parts == k).coalesce(1).write.mode("append").parquet(src)
    return src


def test_latest_state_stream_equals_batch(spark):
    src = _split_messages(spark)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    path, ck = scratch_path(spark, "latest"), scratch_path(spark, "ck")
    q = latest_state_stream(parse_readings(stream, keep=("event_id",)), path, ck, {"availableNow": True})
    q.awaitTermination()
    got = sorted(tuple(r) for r in read_latest_state(spark, path).select("sensor_id", "event_id").collect())
    batch = latest_per_sensor(parse_readings(spark.read.parquet(src), keep=("event_id",))
                              .filter(F.col("sensor_id").isin("sensor_1", "sensor_2", "sensor_3", "sensor_4", "motion_sensor")))
    assert got == sorted(tuple(r) for r in batch.select("sensor_id", "event_id").collect())
    assert len(spark.read.parquet(path).select("epoch").distinct().collect()) == 3


def test_failed_batch_is_replayed(spark):
    src = _split_messages(spark, parts=2)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    calls = {"n": 0}

    def flaky(batch, epoch_id):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("sink down")
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")

    def run():
        stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(src)
        q = for_each_batch(stream, flaky, ck, {"availableNow": True})
        q.awaitTermination()

    with pytest.raises(Exception):
        run()
    run()
    assert spark.read.parquet(out).count() == 1000


def test_control_stream_over_batches_equals_batch(spark):
    from sensorstream.operators import control_state
    from sensorstream.sources import control_readings
    from sensorstream.streaming import control_state_stream

    readings = control_readings(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    src = scratch_path(spark, "ctl-src")
    for lo, hi in [(0, 333), (333, 666), (666, 10**9)]:
        readings.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1) \
            .write.mode("append").parquet(src)
    stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", "1").parquet(src)
    out, ck = scratch_path(spark, "ctl-out"), scratch_path(spark, "ctl-ck")
    q = (control_state_stream(stream).writeStream.format("parquet").option("checkpointLocation", ck)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("event_time").collect())
    want = sorted(tuple(r) for r in control_state(spark.read.parquet(src)).drop("event_time").collect())
    assert len(got) == 1000 and got == want


def test_control_stream_passes_late_rows_by(spark):
    import datetime as dt

    from sensorstream.streaming import control_state_stream

    schema = "event_id long, sensor_id string, event_time timestamp_ntz, temperature double, humidity double, waterQuality double"
    t0 = dt.datetime(2024, 1, 1)
    src = scratch_path(spark, "late-src")
    spark.createDataFrame([(1, "sensor_1", t0 + dt.timedelta(seconds=10), 41.0, 50.0, 0.7)], schema) \
        .coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(2, "sensor_1", t0, 10.0, 50.0, 0.7), (3, "sensor_1", t0 + dt.timedelta(seconds=15), 35.0, 50.0, 0.7)],
                          schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(src)
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    q = (control_state_stream(stream).writeStream.format("parquet").option("checkpointLocation", ck)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    rows = {r["event_id"]: r["cooling"] for r in spark.read.parquet(out).collect()}
    assert rows == {1: True, 2: None, 3: True}  # late: no decision, but not lost


def test_history_prunes_partitions_and_pushes_filters(spark):
    from sensorstream.operators import known_sensors, recent_window
    from sensorstream.sources import history, write_history

    readings = parse_readings(raw_messages(spark.read.parquet("/root/testdata/sf0.01/events.parquet")), keep=("event_id",))
    path = scratch_path(spark, "history")
    write_history(readings, path, partition_by=("event_date",))
    h = history(spark, path)
    as_of = F.lit("2024-01-01 16:39:30.25").cast("timestamp_ntz")
    q = recent_window(known_sensors(h), as_of=as_of)
    plan = spark._jvm.PythonSQLUtils.explainString(q._jdf.queryExecution(), "formatted")
    scan = plan[plan.index("Scan parquet"):]
    assert "PartitionFilters: [isnotnull(event_date" in scan and "(event_date" in scan, scan[:2000]
    assert "In(sensor_id" in scan.split("PushedFilters:")[1].split("\n")[0], scan[:2000]
    base = recent_window(known_sensors(readings), as_of=as_of)
    assert q.count() == base.count() > 0


def test_latest_time_reads_only_last_partition(spark):
    from sensorstream.operators import known_sensors, latest_time, recent_window
    from sensorstream.sources import history, write_history

    readings = parse_readings(raw_messages(spark.read.parquet("/root/testdata/sf0.1/events.parquet")), keep=("event_id",))
    path = scratch_path(spark, "history-days")
    write_history(readings, path, partition_by=("event_date",))
    h = known_sensors(history(spark, path))
    assert len(h.select("event_date").distinct().collect()) > 3
    as_of = h.select(latest_time(h).alias("t"))
    inner = spark._jvm.PythonSQLUtils.explainString(as_of._jdf.queryExecution(), "formatted")
    import re

    # every scan that reads event_time is limited to the last day at run time
    scans = [blk for blk in re.findall(r"\(\d+\) Scan parquet.*?(?:\n\n|$)", inner, re.S)
             if re.search(r"Output \[\d+\]: \[[^\]]*event_time", blk)]
    assert scans, inner[:3000]
    for blk in scans:
        filters = re.search(r"PartitionFilters: (.*)", blk).group(1)
        assert "event_date" in filters and "Subquery" in filters, blk
    want = known_sensors(readings).agg(F.max("event_time")).collect()[0][0]
    assert as_of.limit(1).collect()[0]["t"] == want
    assert recent_window(h, latest_time(h)).count() == recent_window(known_sensors(readings), latest_time(known_sensors(readings))).count()


def test_sessions_stream_over_batches_equals_batch(spark):
    from sensorstream.operators import explode_alerts, incident_sessions, known_sensors
    from sensorstream.streaming import append_closing, incident_sessions_stream, with_event_ts

    msgs = raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    src = scratch_path(spark, "sess-src")
    for lo, hi in [(0, 300), (300, 700), (700, 10**9)]:  # time order: event_id grows with time
        msgs.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.mode("append").parquet(src)
    data = parse_readings(spark.read.parquet(src), keep=("event_id",))
    append_closing(spark, src)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    readings = with_event_ts(parse_readings(stream, keep=("event_id",)))
    out, ck = scratch_path(spark, "sess-out"), scratch_path(spark, "sess-ck")
    q = (incident_sessions_stream(readings).writeStream.format("parquet").option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start(out))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("sensor_id", "alert_type", "start_time", "last_time", "n_alerts").collect())
    alerts = explode_alerts(known_sensors(data.filter(F.col("event_id") >= 0)))
    want = sorted(tuple(r) for r in incident_sessions(alerts).select("sensor_id", "alert_type", "start_time", "last_time", "n_alerts").collect())
    assert len(q.recentProgress) >= 3 and got == want


def test_latest_state_compaction(spark):
    from sensorstream.streaming import compact_latest_state

    src = _split_messages(spark)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    path, ck = scratch_path(spark, "latest-c"), scratch_path(spark, "ck-c")
    latest_state_stream(parse_readings(stream, keep=("event_id",)), path, ck, {"availableNow": True}).awaitTermination()
    full = sorted(tuple(r) for r in read_latest_state(spark, path).collect())
    snap = scratch_path(spark, "snap") + "/state"
    compact_latest_state(spark, path, snap)
    # after the snapshot, only newer epochs are read; with none newer the answer is the snapshot
    got = sorted(tuple(r) for r in read_latest_state(spark, path, snapshot=snap).select(*read_latest_state(spark, path).columns).collect())
    assert got == full and spark.read.parquet(snap).count() == 5


def test_control_stream_restart_keeps_state(spark):
    from sensorstream.operators import control_state
    from sensorstream.sources import control_readings
    from sensorstream.streaming import control_state_stream

    readings = control_readings(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    src, out, ck = scratch_path(spark, "rs-src"), scratch_path(spark, "rs-out"), scratch_path(spark, "rs-ck")

    def run():
        stream = spark.readStream.schema(readings.schema).parquet(src)
        q = (control_state_stream(stream).writeStream.format("parquet").option("checkpointLocation", ck)
             .trigger(availableNow=True).start(out))
        q.awaitTermination()

    readings.filter(F.col("event_id") < 500).coalesce(1).write.mode("append").parquet(src)
    run()  # first run stops here; its state is in the checkpoint
    readings.filter(F.col("event_id") >= 500).coalesce(1).write.mode("append").parquet(src)
    run()  # restart on the same checkpoint continues from the stored state
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("event_time").collect())
    want = sorted(tuple(r) for r in control_state(readings).drop("event_time").collect())
    assert len(got) == 1000 and got == want


def test_latest_state_readable_before_any_batch(spark):
    src, path, ck = scratch_path(spark, "empty-src"), scratch_path(spark, "empty-latest"), scratch_path(spark, "empty-ck")
    stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(src)
    latest_state_stream(parse_readings(stream, keep=("event_id",)), path, ck, {"availableNow": True}).awaitTermination()
    state = read_latest_state(spark, path)
    assert state.count() == 0 and "temperature" in state.columns


@pytest.mark.parametrize("seed", [3, 4])
def test_sessions_stream_with_late_rows_within_delay_equals_batch(spark, seed):
    import datetime as dt
    import json
    import random

    from sensorstream.operators import explode_alerts, incident_sessions, known_sensors
    from sensorstream.streaming import append_closing, incident_sessions_stream, rows_dropped_by_watermark, with_event_ts

    rnd = random.Random(seed)
    t0, rows, t = dt.datetime(2024, 1, 1), [], {"sensor_1": 0.0, "sensor_2": 0.0}
    for i in range(240):
        s = rnd.choice(list(t))
        t[s] += rnd.choice([5, 20, 45, 60, 61, 90, 200])
        rows.append((i, s, t[s]))
    rows.sort(key=lambda r: r[2])
    files = [rows[len(rows) * k // 3:len(rows) * (k + 1) // 3] for k in range(3)]
    # move a few rows of each chunk into the next file: they arrive one batch late, < 2 min late
    for k in range(2):
        late = [r for r in files[k] if r[2] > files[k][-1][2] - 120 and rnd.random() < 0.5]
        files[k] = [r for r in files[k] if r not in late]
        files[k + 1] = late + files[k + 1]

    def msg(r):
        return (r[0], json.dumps({"sensor_id": r[1], "temperature": 45.0,
                                  "timestamp": (t0 + dt.timedelta(seconds=r[2])).isoformat()}))

    src = scratch_path(spark, "late-sess")
    for part in files:
        spark.createDataFrame([msg(r) for r in part], MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    data = parse_readings(spark.read.parquet(src), keep=("event_id",))
    want = sorted(tuple(r) for r in incident_sessions(explode_alerts(known_sensors(data)).select(
        "event_id", "sensor_id", "event_time", "alert_type")).collect())
    append_closing(spark, src)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    out, ck = scratch_path(spark, "late-sess-out"), scratch_path(spark, "late-sess-ck")
    q = (incident_sessions_stream(with_event_ts(parse_readings(stream, keep=("event_id",)), "10 minutes"))
         .writeStream.format("parquet").option("checkpointLocation", ck).outputMode("append")
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(
        "sensor_id", "alert_type", "start_time", "last_time", "n_alerts").collect())
    assert rows_dropped_by_watermark(q) == 0 and got == want


def test_chained_compaction_with_new_epochs(spark):
    from sensorstream.streaming import compact_latest_state

    msgs = raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    src, path, ck = scratch_path(spark, "cc-src"), scratch_path(spark, "cc-latest"), scratch_path(spark, "cc-ck")

    def run():
        stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
        latest_state_stream(parse_readings(stream, keep=("event_id",)), path, ck, {"availableNow": True}).awaitTermination()

    msgs.filter(F.col("event_id") < 500).coalesce(1).write.mode("append").parquet(src)
    run()
    snap1 = scratch_path(spark, "cc-snap") + "/s1"
    compact_latest_state(spark, path, snap1)
    msgs.filter(F.col("event_id") >= 500).coalesce(1).write.mode("append").parquet(src)
    run()  # new epochs after the first snapshot
    snap2 = scratch_path(spark, "cc-snap") + "/s2"
    compact_latest_state(spark, path, snap2, previous=snap1)
    full = sorted(tuple(r) for r in read_latest_state(spark, path).collect())
    cols = read_latest_state(spark, path).columns
    via1 = sorted(tuple(r) for r in read_latest_state(spark, path, snapshot=snap1).select(*cols).collect())
    via2 = sorted(tuple(r) for r in read_latest_state(spark, path, snapshot=snap2).select(*cols).collect())
    assert full == via1 == via2 and max(r[0] for r in spark.read.parquet(snap2).select("epoch").collect()) >= 1


def test_latest_state_log_orders_by_event_time(spark):
    """A new checkpoint on an old log: the newest reading wins, and no folder of the old run is replaced."""
    import json

    from sensorstream.streaming import compact_latest_state, refresh_latest_state

    path = scratch_path(spark, "latest-runs")

    def feed(name: str, rows: list[tuple]) -> None:
        src = scratch_path(spark, name)
        msgs = [(i, json.dumps({"sensor_id": s, "timestamp": t, "temperature": v})) for i, s, t, v in rows]
        spark.createDataFrame(msgs, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(src)
        latest_state_stream(parse_readings(stream, keep=("event_id",)), path, scratch_path(spark, f"{name}-ck"),
                            {"availableNow": True}).awaitTermination()

    feed("run-a", [(1, "sensor_1", "2024-01-02T00:00:00", 20.0), (2, "sensor_2", "2024-01-01T00:00:00", 21.0)])
    feed("run-b", [(3, "sensor_1", "2024-01-01T00:00:00", 22.0)])
    want = {"sensor_1": 1, "sensor_2": 2}
    assert {r["sensor_id"]: r["event_id"] for r in read_latest_state(spark, path).collect()} == want
    snaps = scratch_path(spark, "snaps") + "/s"
    assert {r["sensor_id"]: r["event_id"] for r in refresh_latest_state(spark, path, snaps).collect()} == want
    feed("run-c", [(4, "sensor_2", "2024-01-03T00:00:00", 23.0)])
    want["sensor_2"] = 4
    assert {r["sensor_id"]: r["event_id"] for r in refresh_latest_state(spark, path, snaps).collect()} == want
    with pytest.raises(ValueError):
        compact_latest_state(spark, path, snaps, previous=snaps)
