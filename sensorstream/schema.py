"""Record layouts shared by every job (batch and streaming)."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types are the wire format of the input topic.
# One sensor sample as it travels there. Declared once, never
# inferred: unknown JSON fields are ignored, missing ones come back null.
READING_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("temperature", T.DoubleType(), True),
        T.StructField("humidity", T.DoubleType(), True),
        T.StructField("waterQuality", T.DoubleType(), True),
        T.StructField("insectPresence", T.DoubleType(), True),
        T.StructField("motion", T.DoubleType(), True),
    ]
)

READING_COLUMNS = tuple(f.name for f in READING_SCHEMA.fields)
MEASUREMENTS = ("temperature", "humidity", "waterQuality", "insectPresence", "motion")

# Archived reading: the seven reading fields, then the first broken rule.
ENRICHED_SCHEMA = T.StructType(
    READING_SCHEMA.fields
    + [
        T.StructField("alert_type", T.StringType(), True),
        T.StructField("alert_value", T.StringType(), True),
    ]
)
ENRICHED_COLUMNS = tuple(f.name for f in ENRICHED_SCHEMA.fields)

# Typed event time derived from the ``timestamp`` text (naive wall clock).
EVENT_TIME = "event_time"

# Calendar date of ``event_time``: the partition column of stored history.
EVENT_DATE = "event_date"
