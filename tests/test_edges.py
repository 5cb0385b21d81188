"""Hand-written edge rows: parsing, rule semantics, panels, archive, clamp."""

import json
import math

from pyspark.sql import functions as F

from sensorstream.functions import archive_json, normalise_readings, parse_readings, display_time
from sensorstream.operators import (alert_message, all_alerts, explode_alerts, first_alert, latest_per_sensor,
                                    panel_insects, panel_motion, panel_temperature, recent_window)
from sensorstream.sources.config import kafka_options, parse_properties


def _msgs(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id long, value string")


def _parse(spark, values):
    return parse_readings(_msgs(spark, values), keep=("event_id",))


def _one(spark, **fields):
    fields.setdefault("sensor_id", "sensor_1")
    fields.setdefault("timestamp", "2024-01-01T00:00:00")
    return _parse(spark, [json.dumps(fields)])


def _first(spark, **fields):
    r = first_alert(_one(spark, **fields)).collect()[0]
    return r["alert_type"], r["alert_value"]


def test_thresholds_are_strict(spark):
    for f, v in [("temperature", 40.0), ("temperature", 15.0), ("humidity", 35.0), ("humidity", 75.0),
                 ("waterQuality", 0.6)]:
        assert _first(spark, **{f: v}) == (None, None)


def test_precedence_and_all_alerts(spark):
    df = _one(spark, temperature=41, humidity=20, insectPresence=1)
    r = all_alerts(first_alert(df)).collect()[0]
    assert (r["alert_type"], r["alert_value"]) == ("High_temperature", "41.0")
    assert r["alert_list"] == ["Temp. Haute", "Humidité Basse", "Insectes"]
    assert explode_alerts(df).count() == 3


def test_null_falls_through_and_int_as_double(spark):
    assert _first(spark, humidity=20.0) == ("Low_humidity", "20.0")
    assert _first(spark, insectPresence=1) == ("Insect_Detected", "1.0")
    assert _first(spark, motion=1) == ("Motion_Detected", "1.0")


def test_nan_breaks_no_rule(spark):
    df = spark.createDataFrame([("s", float("nan"), 50.0)], "sensor_id string, temperature double, humidity double")
    df = df.withColumns({c: F.lit(None).cast("double") for c in ("waterQuality", "insectPresence", "motion")})
    r = all_alerts(first_alert(df)).collect()[0]
    assert r["alert_type"] is None and r["alert_list"] is None


def test_wrong_type_nulls_only_that_field(spark):
    rows = _parse(spark, ['{"sensor_id":"s","temperature":"hot","humidity":20}',
                          '{"sensor_id":"s","temperature":"41.5","humidity":20}']).collect()
    for r in rows:
        assert r["temperature"] is None and r["humidity"] == 20.0 and r["sensor_id"] == "s"


def test_bad_json_is_kept_as_null_row(spark):
    df = _parse(spark, ["{bad", '[{"sensor_id":"x"}]', "", None])
    rows = first_alert(df).collect()
    assert len(rows) == 4
    for r in rows:
        assert all(r[c] is None for c in ("sensor_id", "timestamp", "temperature", "alert_type", "event_time"))


def test_iso_forms_and_bad_time(spark):
    df = _parse(spark, [json.dumps({"timestamp": t}) for t in
                        ["2024-01-01T00:00:00", "2024-01-01T00:00:00.123456", "x"]] + ['{"sensor_id":"a"}'])
    times = [r["event_time"] for r in df.orderBy("event_id").collect()]
    assert times[0] is not None and times[1].microsecond == 123456
    assert times[2] is None and times[3] is None


def test_display_time(spark):
    df = spark.createDataFrame([("2024-01-01T01:02:03.4",), ("abc",), (None,)], "t string")
    assert [r[0] for r in df.select(display_time("t")).collect()] == ["01:02:03", "", None]


def test_window_edge_and_future(spark):
    df = _parse(spark, [json.dumps({"sensor_id": "sensor_1", "timestamp": t}) for t in
                        ["2024-01-01T00:00:00", "2023-12-31T23:59:59.999999", "2024-01-02T00:00:00"]])
    as_of = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    kept = sorted(r["event_id"] for r in recent_window(df, as_of).collect())
    assert kept == [0, 2]


def test_latest_ignores_bad_time_and_breaks_ties(spark):
    df = _parse(spark, [json.dumps({"sensor_id": "sensor_1", "timestamp": t, "temperature": v}) for t, v in
                        [("2024-01-01T00:00:01", 1.0), ("2024-01-01T00:00:01", 2.0), ("garbage", 3.0)]])
    r = latest_per_sensor(df).collect()
    assert len(r) == 1 and r[0]["temperature"] == 2.0 and r[0]["event_id"] == 1


def test_panels(spark):
    state = spark.createDataFrame(
        [("sensor_1", 41.0, None), ("sensor_2", float("nan"), 1.0), ("sensor_3", 20.0, 0.0),
         ("motion_sensor", None, None)],
        "sensor_id string, temperature double, insectPresence double").withColumn("motion", F.lit(None).cast("double"))
    t = {r["sensor_id"]: (r["in_alarm"], r["colour"]) for r in panel_temperature(state).collect()}
    assert t == {"sensor_1": (True, "#ff4d4d"), "sensor_2": (False, "#3498db"), "sensor_3": (False, "#3498db")}
    ins = {r["sensor_id"]: (r["value"], r["colour"]) for r in panel_insects(state).collect()}
    assert ins == {"sensor_1": (1.0, "#bdc3c7"), "sensor_2": (1.0, "#8e44ad"), "sensor_3": (0.05, "#bdc3c7")}
    mot = panel_motion(state).collect()
    assert [(r["sensor_id"], r["value"], r["colour"]) for r in mot] == [("motion_sensor", 1.0, "#bdc3c7")]


def test_archive_keeps_all_keys_with_nulls(spark):
    enriched = first_alert(_parse(spark, ['{"sensor_id":"motion_sensor","timestamp":"2024-01-01T00:00:00","motion":1}']))
    value = archive_json(enriched).collect()[0]["value"]
    doc = json.loads(value)
    assert list(doc) == ["sensor_id", "timestamp", "temperature", "humidity", "waterQuality", "insectPresence",
                         "motion", "alert_type", "alert_value"]
    assert doc["temperature"] is None and doc["alert_type"] == "Motion_Detected" and doc["alert_value"] == "1.0"


def test_clamp(spark):
    df = spark.createDataFrame([(55.0, 5.0, 1.5), (5.0, 95.0, -1.0), (None, 33.333, 0.125)],
                               "temperature double, humidity double, waterQuality double")
    rows = normalise_readings(df).collect()
    assert [tuple(r) for r in rows] == [(50.0, 10.0, 1.0), (10.0, 90.0, 0.0), (None, 33.33, 0.13)]
    nan = normalise_readings(spark.createDataFrame([(float("nan"), 1.0, 1.0)], "temperature double, humidity double, waterQuality double")).collect()[0]
    assert math.isnan(nan["temperature"])


def test_messages(spark):
    df = spark.createDataFrame([("High_temperature", "sensor_1"), ("Low_Water_Quality", "s2"), ("other", "s3")],
                               "code string, sensor string")
    msgs = [r[0] for r in df.select(alert_message(F.col("code"), F.col("sensor"))).collect()]
    assert msgs[0] == "Alerte ! Le détecteur 'sensor_1' détecte une température trop haute."
    assert msgs[1] == "Alerte ! Le détecteur 's2' détecte une qualité de l'eau trop faible."
    assert msgs[2] is None


def test_properties_and_kafka_options():
    conf = parse_properties("bootstrap.servers=host:9092\n# c\nsasl.username= # fill in\nsasl.password= # fill in\n")
    opts = kafka_options(conf)
    assert opts == {"kafka.bootstrap.servers": "host:9092", "subscribe": "IOT_sensor", "startingOffsets": "latest"}
    opts = kafka_options({"sasl.username": "u", "sasl.password": "p"})
    assert opts["kafka.bootstrap.servers"] == "localhost:9092"
    assert opts["kafka.security.protocol"] == "SASL_SSL" and opts["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="u" password="p";' in opts["kafka.sasl.jaas.config"]


def test_time_arithmetic_ignores_session_zone(spark):
    import datetime as dt

    from sensorstream.functions import epoch_micros, from_epoch_micros

    vals = [dt.datetime(2024, 3, 10, 2, 30, 0, 123456), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 7, 1, 12),
            dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
        rows = df.select(epoch_micros("t").alias("us"), from_epoch_micros(epoch_micros("t")).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for r, v in zip(rows, vals):
        assert r["us"] == (v - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert r["back"] == v


def test_json_keys_case_duplicates_and_trailing_text(spark):
    rows = {r["event_id"]: r["sensor_id"] for r in _parse(spark, [
        '{"sensor_id":"a","sensor_id":"b"}', '{"Sensor_id":"a"}', '{"sensor_id":"a"} trailing']).collect()}
    assert rows == {0: "b", 1: None, 2: "a"}


def test_for_each_batch_with_persist(spark):
    from sensorstream.session import scratch_path
    from sensorstream.sources import for_each_batch
    from sensorstream.sources.readers import MESSAGE_SCHEMA

    src, ck = scratch_path(spark, "feb-src"), scratch_path(spark, "feb-ck")
    _msgs(spark, ['{"sensor_id":"a"}', '{"sensor_id":"b"}']).write.mode("append").parquet(src)
    seen = []

    def twice(batch, epoch_id):
        seen.append((batch.count(), batch.filter("value like '%a%'").count()))

    q = for_each_batch(spark.readStream.schema(MESSAGE_SCHEMA).parquet(src), twice, ck, {"availableNow": True}, persist=True)
    q.awaitTermination()
    assert seen == [(2, 1)]


def test_operators_accept_empty_input(spark):
    from sensorstream.operators import (alert_gaps, control_state, explode_alerts, incident_counts,
                                        incident_sessions, incident_starts, incident_total, known_sensors)

    readings = parse_readings(_msgs(spark, ['{"sensor_id":"x"}']), keep=("event_id",)).filter("false")
    enriched = first_alert(readings)
    alerts = explode_alerts(known_sensors(readings)).select("event_id", "sensor_id", "event_time", "alert_type")
    assert enriched.count() == 0 and alerts.count() == 0
    assert latest_per_sensor(readings.drop("timestamp")).count() == 0
    for op in (alert_gaps, incident_starts, incident_sessions, incident_counts):
        assert op(alerts).count() == 0
    assert incident_total(alerts).collect()[0]["n_incidents"] == 0
    assert control_state(readings).count() == 0


def test_jaas_values_are_escaped():
    opts = kafka_options({"sasl.username": 'u"x', "sasl.password": 'p\\"; evil'})
    assert opts["kafka.sasl.jaas.config"].endswith('username="u\\"x" password="p\\\\\\"; evil";')


def test_latest_with_two_column_tie(spark):
    df = _parse(spark, [json.dumps({"sensor_id": "sensor_1", "timestamp": "2024-01-01T00:00:01", "temperature": v})
                        for v in (1.0, 2.0, 3.0)]).withColumn("partition", F.col("event_id") % 2)
    r = latest_per_sensor(df.drop("timestamp"), tie_col=("partition", "event_id")).collect()
    assert len(r) == 1 and r[0]["temperature"] == 2.0  # partition 1 beats partition 0


def test_known_sensors_from_a_registry_table(spark):
    from sensorstream.operators import known_sensors

    df = _parse(spark, [json.dumps({"sensor_id": s}) for s in ("sensor_1", "sensor_9", "sensor_1", None)])
    registry = spark.createDataFrame([("sensor_1",), ("sensor_2",), ("sensor_1",)], "sensor_id string")
    assert sorted(r["event_id"] for r in known_sensors(df, registry).collect()) == [0, 2]
    assert sorted(r["event_id"] for r in known_sensors(df, ["sensor_1"]).collect()) == [0, 2]
