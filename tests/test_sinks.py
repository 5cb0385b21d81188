"""Writers and streaming job lifecycle."""

import datetime as dt
import json

from pyspark.sql import functions as F

from sensorstream.functions import parse_archive, parse_readings
from sensorstream.operators import first_alert
from sensorstream.session import scratch_path
from sensorstream.sources import history, publish_readings, raw_messages, tick_readings, write_archive
from sensorstream.sources.readers import MESSAGE_SCHEMA
from sensorstream.streaming import (incident_sessions_stream, rows_dropped_by_watermark, start_archive_and_history,
                                    stop_all, with_event_ts)

from paths import SF_SMALL


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_batch_publish_then_read_back(spark):
    out = scratch_path(spark, "publish")
    publish_readings(tick_readings(_events(spark)), fmt="json", target=out, key_col="event_id")
    msgs = spark.read.json(out, schema="key string, value string")
    parsed = parse_readings(msgs, keep=("key",))
    assert parsed.count() == 1000 and parsed.filter(F.col("sensor_id").isNull()).count() == 0
    motion = json.loads(msgs.filter(F.col("key") == "4").collect()[0]["value"])
    assert set(motion) == {"sensor_id", "timestamp", "motion"}


def test_batch_archive_writer(spark):
    out = scratch_path(spark, "archive")
    enriched = first_alert(parse_readings(raw_messages(_events(spark)), keep=("event_id",)))
    write_archive(enriched, fmt="parquet", target=out, key_col="event_id")
    back = parse_archive(spark.read.parquet(out))
    assert back.count() == 1000
    assert back.filter(F.col("alert_type").isNotNull()).count() == enriched.filter(F.col("alert_type").isNotNull()).count()


def test_two_queries_on_one_stream_and_memory_history(spark):
    src = scratch_path(spark, "msgs")
    raw_messages(_events(spark)).write.mode("append").parquet(src)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(src)
    ck, arch = scratch_path(spark, "ck"), scratch_path(spark, "arch")
    qs = start_archive_and_history(stream, "iot_raw_history", ck, archive_fmt="parquet", archive_target=arch,
                                   history_fmt="memory", trigger={"availableNow": True})
    try:
        for q in qs:
            q.awaitTermination()
    finally:
        stop_all(qs)
    assert history(spark, "iot_raw_history").count() == 1000
    assert spark.read.parquet(arch).count() == 1000


def test_late_alerts_are_counted_as_dropped(spark):
    t0 = dt.datetime(2024, 1, 1)

    def msg(i, seconds):
        return (i, json.dumps({"sensor_id": "sensor_1", "temperature": 45.0,
                               "timestamp": (t0 + dt.timedelta(seconds=seconds)).isoformat()}))

    src = scratch_path(spark, "late")
    # late rows are filtered with the previous batch's watermark, so the row at
    # 10 s is dropped only when it arrives two batches after the watermark
    # passed it (one batch later it would still merge)
    for rows in ([msg(1, 0), msg(2, 3600)], [msg(4, 7200)], [msg(3, 10)]):
        spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    sessions = incident_sessions_stream(with_event_ts(parse_readings(stream, keep=("event_id",)), "10 minutes"))
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    q = (sessions.writeStream.format("parquet").option("checkpointLocation", ck).outputMode("append")
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert rows_dropped_by_watermark(q) == 1
    got = sorted((r["start_time"], r["n_alerts"]) for r in spark.read.parquet(out).collect())
    assert got == [(t0, 1), (t0 + dt.timedelta(hours=1), 1)]


def test_text_message_source(spark):
    from sensorstream.sources import read_readings

    path = scratch_path(spark, "text-src")
    raw_messages(_events(spark)).select("value").coalesce(1).write.mode("append").text(path)
    rows = read_readings(spark, path, fmt="text")
    assert rows.count() == 1000 and rows.filter(F.col("sensor_id").isNull()).count() == 11


def test_kafka_sink_options():
    from sensorstream.sources import kafka_options
    from sensorstream.sources.sinks import kafka_sink_options

    opts = kafka_sink_options(kafka_options({"bootstrap.servers": "b:9092"}), "IOT_archive")
    assert opts == {"kafka.bootstrap.servers": "b:9092", "topic": "IOT_archive"}


def test_dashboard_job(spark):
    from sensorstream.operators import explode_alerts, incident_sessions, known_sensors, latest_per_sensor
    from sensorstream.streaming import append_closing, read_latest_state, start_dashboard_job

    src = scratch_path(spark, "dash-src")
    raw_messages(_events(spark)).coalesce(1).write.mode("append").parquet(src)
    append_closing(spark, src)
    root = scratch_path(spark, "dash")
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    qs = start_dashboard_job(stream, root, archive_fmt="parquet", archive_target=f"{root}/archive",
                             trigger={"availableNow": True})
    try:
        for q in qs.values():
            q.awaitTermination()
    finally:
        stop_all(qs.values())
    batch = parse_readings(spark.read.parquet(src), keep=("event_id",)).filter(F.col("event_id") >= 0)
    assert spark.read.parquet(f"{root}/history").filter(F.col("event_id") >= 0).count() == 1000
    assert spark.read.parquet(f"{root}/archive").filter(F.col("key") != "-1").count() == 1000
    latest = sorted(tuple(r) for r in read_latest_state(spark, f"{root}/latest").select("sensor_id", "event_id").collect())
    # the closing message is the latest reading of sensor_1 in the stream
    want = {r["sensor_id"]: r["event_id"] for r in latest_per_sensor(known_sensors(batch).drop("timestamp")).collect()}
    want["sensor_1"] = -1
    assert latest == sorted(want.items())
    n_sessions = spark.read.parquet(f"{root}/sessions").count()
    assert n_sessions == incident_sessions(explode_alerts(known_sensors(batch))).count()


def test_spread_small_input(spark):
    from sensorstream.sources import spread_small_input

    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert spread_small_input(many) is many
    assert spread_small_input(spark.range(0, 1000, numPartitions=3), max_parts=2).rdd.getNumPartitions() == 3  # never fewer
    one = spark.range(0, 1000, numPartitions=1)
    spread = spread_small_input(one)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread.count() == 1000


def test_command_line_archive_job(spark):
    from sensorstream.__main__ import main

    src = scratch_path(spark, "cli-src")
    raw_messages(_events(spark)).coalesce(1).write.mode("append").parquet(src)
    ck, out, alerts = scratch_path(spark, "cli-ck"), scratch_path(spark, "cli-out"), scratch_path(spark, "cli-alerts")
    msgs = scratch_path(spark, "cli-msgs")
    qs = main(["archive", "--config", "/nonexistent.properties", "--source-format", "parquet", "--source", src,
               "--sink-format", "parquet", "--sink", out, "--checkpoint", ck, "--alerts", alerts,
               "--messages", msgs, "--once"], spark)
    try:
        for q in qs.values():
            q.awaitTermination()
    finally:
        stop_all(qs.values())
    assert spark.read.parquet(out).count() == 1000
    table = spark.read.parquet(alerts)
    assert table.columns == ["Timestamp", "Sensor", "Alert Type", "Value"] and table.count() > 0
    notes = spark.read.parquet(msgs)
    assert notes.count() == table.count() and notes.filter(F.col("message").startswith("Alerte ! ")).count() == notes.count()


def test_streaming_history_partitioned_by_day(spark):
    from sensorstream.sources import write_history

    src = scratch_path(spark, "hist-src")
    raw_messages(spark.read.parquet("/root/testdata/sf0.01/events.parquet")).write.mode("append").parquet(src)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(src)
    path, ck = scratch_path(spark, "hist"), scratch_path(spark, "hist-ck")
    q = write_history(parse_readings(stream, keep=("event_id",)), path, checkpoint=ck,
                      trigger={"availableNow": True}, partition_by=("event_date",))
    q.awaitTermination()
    h = history(spark, path)
    days = sorted(r[0] for r in h.select("event_date").distinct().collect() if r[0] is not None)
    assert h.count() == 10000 and len(days) == 1 and str(days[0]) == "2024-01-01"


def test_streaming_publish(spark):
    events_dir = scratch_path(spark, "pub-ev")
    _events(spark).write.mode("append").parquet(events_dir)
    stream = tick_readings(spark.readStream.schema(_events(spark).schema).parquet(events_dir))
    out, ck = scratch_path(spark, "pub-out"), scratch_path(spark, "pub-ck")
    q = publish_readings(stream, fmt="parquet", target=out, checkpoint=ck, trigger={"availableNow": True},
                         key_col="event_id")
    q.awaitTermination()
    back = parse_readings(spark.read.parquet(out), keep=("key",))
    assert back.count() == 1000 and back.filter(F.col("sensor_id").isNull()).count() == 0


def test_command_line_dashboard_job(spark):
    from sensorstream.__main__ import main
    from sensorstream.streaming import append_closing, read_latest_state

    src = scratch_path(spark, "cli-dash-src")
    raw_messages(_events(spark)).coalesce(1).write.mode("append").parquet(src)
    append_closing(spark, src)
    root = scratch_path(spark, "cli-dash")
    qs = main(["dashboard", "--config", "/nonexistent.properties", "--source-format", "parquet", "--source", src,
               "--sink-format", "parquet", "--sink", f"{root}/archive", "--root", root, "--once"], spark)
    try:
        for q in qs.values():
            q.awaitTermination()
    finally:
        stop_all(qs.values())
    assert set(qs) == {"history", "archive", "latest", "sessions"}
    assert read_latest_state(spark, f"{root}/latest").count() == 5
    assert spark.read.parquet(f"{root}/sessions").count() > 0
    for _ in range(2):  # the second refresh starts from the first one's snapshot
        main(["panels", "--root", root, "--as-of", "data"], spark)
    assert spark.read.parquet(f"{root}/panels/temperature").count() == 4
    state = [r[0] for r in spark.read.parquet(f"{root}/panels/state").select("sensor_id").collect()]
    assert len(state) == 5 and state == sorted(state)


def test_panels_count_open_incidents(spark):
    """No closing message: the last incidents are still open, and counted."""
    from sensorstream.__main__ import main
    from sensorstream.operators import known_sensors
    from sensorstream.plans import data_anchored_dashboard

    src = scratch_path(spark, "open-src")
    raw_messages(_events(spark)).coalesce(1).write.mode("append").parquet(src)
    root = scratch_path(spark, "open-dash")
    qs = main(["dashboard", "--config", "/nonexistent.properties", "--source-format", "parquet", "--source", src,
               "--sink-format", "parquet", "--sink", f"{root}/archive", "--root", root, "--once"], spark)
    try:
        for q in qs.values():
            q.awaitTermination()
    finally:
        stop_all(qs.values())
    main(["panels", "--root", root, "--as-of", "data"], spark)
    want = data_anchored_dashboard(parse_readings(spark.read.parquet(src), keep=("event_id",)))
    got = [tuple(r) for r in spark.read.parquet(f"{root}/panels/incidents").collect()]
    assert sorted(got) == sorted(tuple(r) for r in want.incidents.collect()) and len(got) > 0
    assert spark.read.parquet(f"{root}/panels/total").first()[0] == want.total.first()[0] == sum(n for _, n in got)
    assert spark.read.parquet(f"{root}/panels/alerts").count() == want.alerts.count()
    day = spark.read.parquet(f"{root}/history").filter(F.col("event_date") == F.lit("2024-01-01").cast("date"))
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().toString()
    assert "event_date" in spark.read.parquet(f"{root}/sessions").columns
    assert known_sensors(day).count() > 0
