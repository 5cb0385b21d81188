"""Golden values of FIXTURES.md, worked out independently of this code."""

from pyspark.sql import functions as F

from sensorstream.operators import control_state, first_alert, known_sensors, latest_per_sensor
from sensorstream.sources import control_readings, tick_readings


def _typed(spark, sf):
    ev = spark.read.parquet(f"/root/testdata/sf{sf}/events.parquet")
    return tick_readings(ev).withColumn("event_time", F.col("rts")).drop("rts")


def test_first_match_counts_sf0001(spark):
    got = {r["alert_type"]: r["n"] for r in first_alert(_typed(spark, "0.001")).groupBy("alert_type").agg(F.count("*").alias("n")).collect()}
    assert got == {"High_temperature": 202, "Low_temperature": 96, "Low_humidity": 155, "High_humidity": 95,
                   "Low_Water_Quality": 156, "Insect_Detected": 11, "Motion_Detected": 20, None: 265}


def test_latest_per_sensor_sf001(spark):
    state = latest_per_sensor(known_sensors(_typed(spark, "0.01")).drop("timestamp"))
    got = {r["sensor_id"]: (r["temperature"], r["humidity"], r["waterQuality"], r["insectPresence"], r["motion"], r["event_id"])
           for r in state.collect()}
    assert got == {
        "motion_sensor": (None, None, None, None, 0.0, 9999),
        "sensor_1": (36.23, 45.26, 0.38, 0.0, None, 9995),
        "sensor_2": (35.4, 52.42, 0.79, 0.0, None, 9996),
        "sensor_3": (34.57, 59.58, 0.19, 0.0, None, 9997),
        "sensor_4": (33.74, 66.74, 0.6, 0.0, None, 9998),
    }


def test_actuator_counts_sf0001(spark):
    out = control_state(control_readings(spark.read.parquet("/root/testdata/sf0.001/events.parquet")))
    got = out.agg(*[F.count_if(F.col(c)).alias(c) for c in
                    ("cooling", "heating", "humidifying", "dehumidifying", "purifying")]).collect()[0].asDict()
    assert got == {"cooling": 168, "heating": 121, "humidifying": 518, "dehumidifying": 187, "purifying": 595}
