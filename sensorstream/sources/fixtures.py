"""Reading tables derived from the ``events`` table.

The test data has no sensor readings, so the queries derive them.
:func:`field_readings` takes all of a row's columns: ``ts`` (its hour) and
``props`` (a second of the hour) give the time, so that readings come in bursts,
out of order and with ties; ``user_id`` names the sensor (one holds a third of
the rows, some are unknown); ``value``, ``props`` and ``event_type`` give the
measurements, partly missing or out of their physical range. Some messages are
malformed.

:func:`tick_readings` uses ``event_id`` only: a 30 s tick of five sensors whose
values hit the alert thresholds exactly; golden values are stated for it. Row
count and work grow with ``events`` in both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonio import payload, reading_json
from ..functions.time import epoch_micros, from_epoch_micros
from ..schema import READING_COLUMNS

START_MICROS = 1_704_067_200_000_000  # 2024-01-01 00:00:00
TICK_SECONDS = 30
OFFSET_MICROS = 250_000
BAD_JSON = "{bad"


EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table, spread over the cores when it is a single split."""
    from .readers import read_messages, spread_small_input

    return spread_small_input(read_messages(spark, f"{sf_dir.rstrip('/')}/events.parquet", "parquet", schema=EVENTS_SCHEMA))


def _field_columns() -> dict[str, Column]:
    """Sensor, time and measurements of an ``events`` row."""
    u, kind = F.col("user_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("long")
    cents = F.round(F.col("value") * 100).cast("long")
    part = u % 6
    sensor = (
        F.when(u % 53 == 7, "sensor_99").when(part <= 1, "sensor_1").when(part == 5, "motion_sensor")
        .otherwise(F.concat(F.lit("sensor_"), part.cast("string")))
    )
    # views carry the fraction of their second
    second = epoch_micros(F.date_trunc("HOUR", "ts").cast("timestamp_ntz")) + k * 1_000_000
    micros = F.when(kind == "view", epoch_micros("ts") % 1_000_000).otherwise(F.lit(0))
    return {
        "sensor": sensor, "rts": from_epoch_micros(second + micros),
        "temperature": (cents * 10 + k % 2 * 4).cast("double") / F.lit(1000.0),
        "humidity": F.when(k % 10 != 3, _scaled(cents * 7 % 10001)),
        "waterQuality": _scaled(k * 13 % 121),
        "insect": F.when(kind == "error", 1.0).otherwise(0.0),
        "motion": F.when(kind.isin("click", "purchase"), 1.0).otherwise(0.0),
    }


def field_readings(ev: DataFrame) -> DataFrame:
    """Typed readings of all ``events`` columns: ``event_id``, the seven reading fields and ``rts``."""
    c = _field_columns()
    rows = ev.select("event_id", *(v.alias(n) for n, v in c.items()))
    on_motion = F.col("sensor") == "motion_sensor"
    whole = F.date_part(F.lit("SECOND"), "rts") % 1 == 0
    text = F.when(whole, F.date_format("rts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format("rts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return rows.select(
        "event_id", F.col("sensor").alias("sensor_id"), text.alias("timestamp"),
        *(F.when(~on_motion, F.col(m)).alias(n) for m, n in (("temperature", "temperature"), ("humidity", "humidity"), ("waterQuality", "waterQuality"), ("insect", "insectPresence"))),
        F.when(on_motion, F.col("motion")).alias("motion"), "rts",
    )


def _scaled(expr: Column) -> Column:
    return expr.cast("double") / F.lit(100.0)


def _temperature(e: Column) -> Column:
    return _scaled(F.lit(1000) + (e * 7919) % 4001)


def _humidity(e: Column) -> Column:
    return _scaled(F.lit(1000) + (e * 104729) % 8001)


def _water(e: Column) -> Column:
    return _scaled((e * 1299709) % 101)


def tick_readings(ev: DataFrame) -> DataFrame:
    """Typed readings of a fixed tick: ``event_id`` + the seven reading fields + ``rts``."""
    e = F.col("event_id")
    k, i = F.expr("event_id div 5"), e % 5
    motion_row = i == 4
    flag = F.when((k * 7 + i * 3) % 10 == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    none = F.lit(None).cast("double")
    rts = from_epoch_micros(F.lit(START_MICROS + OFFSET_MICROS) + k * (TICK_SECONDS * 1_000_000))
    sensor = (
        F.when(e % 53 == 7, F.lit("sensor_99"))
        .when(motion_row, F.lit("motion_sensor"))
        .otherwise(F.concat(F.lit("sensor_"), (i + 1).cast("string")))
    )
    return ev.select(
        e.alias("event_id"),
        sensor.alias("sensor_id"),
        F.date_format(rts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.when(motion_row, none).otherwise(_temperature(e)).alias("temperature"),
        F.when(motion_row, none).otherwise(_humidity(e)).alias("humidity"),
        F.when(motion_row, none).otherwise(_water(e)).alias("waterQuality"),
        F.when(motion_row, none).otherwise(flag).alias("insectPresence"),
        F.when(motion_row, flag).alias("motion"),
        rts.alias("rts"),
    )


def field_messages(ev: DataFrame, binary: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """JSON messages ``(event_id, value)`` of :func:`field_readings` as sensors publish them, ``value``
    as text or (as from Kafka) bytes; those of ``user_id % 97 = 13`` are malformed. ``keep``: columns of the readings beside them."""
    r = field_readings(ev.withColumn("event_id", F.struct("event_id", "user_id")))
    value = F.when(F.col("event_id.user_id") % 97 == 13, F.lit(BAD_JSON)).otherwise(payload(READING_COLUMNS, keep_nulls=False))
    return r.select("event_id.event_id", (value.cast("binary") if binary else value).alias("value"), *keep)


def raw_messages(ev: DataFrame) -> DataFrame:
    """JSON messages ``(event_id, value)`` of :func:`tick_readings`; every
    97th message (``event_id % 97 = 13``) is malformed."""
    r = tick_readings(ev)
    msg = reading_json(r.select(*READING_COLUMNS, "event_id"), key_col="event_id")
    return msg.select(
        F.col("key").cast("long").alias("event_id"),
        F.when(F.col("key").cast("long") % 97 == 13, F.lit(BAD_JSON)).otherwise(F.col("value")).alias("value"),
    )


def field_control(ev: DataFrame) -> DataFrame:
    """Four environment sensors' readings of all ``events`` columns (controller input)."""
    c = _field_columns()
    return ev.select(
        "event_id", F.concat(F.lit("sensor_"), (F.col("user_id") % 4 + 1).cast("string")).alias("sensor_id"),
        c["rts"].alias("event_time"), c["temperature"].alias("temperature"), c["humidity"].alias("humidity"), c["waterQuality"].alias("waterQuality"),
    )


def control_readings(ev: DataFrame) -> DataFrame:
    """Four environment sensors on a 5 s tick (controller input, no nulls)."""
    e = F.col("event_id")
    t = from_epoch_micros(F.lit(START_MICROS) + F.expr("event_id div 4") * 5_000_000)
    return ev.select(
        e.alias("event_id"),
        F.concat(F.lit("sensor_"), (e % 4 + 1).cast("string")).alias("sensor_id"),
        t.alias("event_time"),
        _temperature(e).alias("temperature"),
        _humidity(e).alias("humidity"),
        _water(e).alias("waterQuality"),
    )
