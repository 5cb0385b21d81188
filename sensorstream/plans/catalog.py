"""Registered queries: one per operator, each over the whole ``events`` table.

Readings are derived from all columns of ``events`` (see ``sources.fixtures``)
and go through the real message path (JSON bytes -> parse) before the operator under test.
The 12 h horizon is anchored at the latest known-sensor reading instead of
the wall clock so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonio import archive_json, parse_archive, reading_json
from ..functions.normalise import normalise_readings
from ..functions.parse import parse_readings
from ..operators.alerts import alert_counts, alert_messages, alert_table, all_alerts, explode_alerts, first_alert
from ..operators.control import control_state
from ..operators.incidents import (alert_gaps, incident_counts, incident_sessions, incident_starts,
                                   incident_total, incidents_in_horizon)
from ..operators.state import (known_sensors, latest_per_sensor, latest_time, panel_humidity, panel_insects,
                               panel_motion, panel_temperature, panel_water)
from ..schema import ENRICHED_COLUMNS, EVENT_TIME, READING_COLUMNS
from ..session import scratch_path
from ..sources.fixtures import events, field_control, field_messages, field_readings
from ..sources.manifest import append_history, recent_history

Query = Callable[[SparkSession, str], DataFrame]


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_readings(field_messages(events(spark, sf_dir), binary=True), keep=("event_id",))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_alert(parsed(spark, sf_dir))


def known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_sensors(parsed(spark, sf_dir))


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    # parsed once, into a stored history; the horizon's end comes from its manifest
    root = scratch_path(spark, "history")
    append_history(parsed(spark, sf_dir), root)
    return recent_history(spark, root)


def recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_alerts(recent(spark, sf_dir)).select("event_id", "sensor_id", EVENT_TIME, "alert_type")


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the current state holds the parsed event time, not the raw text
    return latest_per_sensor(known(spark, sf_dir).drop("timestamp"))


_READING_OUT = ["event_id", *READING_COLUMNS, EVENT_TIME]
_GAP_OUT = ["event_id", "sensor_id", "alert_type", EVENT_TIME, "prev_time", "time_diff"]


def q_parse_readings(spark, d):
    return parsed(spark, d).select(*_READING_OUT)


def q_normalise_readings(spark, d):
    return normalise_readings(parsed(spark, d)).select(*_READING_OUT)


def q_first_alert(spark, d):
    return enriched(spark, d).select("event_id", *ENRICHED_COLUMNS)


def q_all_alerts_list(spark, d):
    lists = all_alerts(parsed(spark, d))
    return lists.select("event_id", F.array_join("alert_list", "|").alias("alert_list"),
                        # explicit: without ANSI mode size(NULL) is -1, not NULL
                        F.when(F.col("alert_list").isNull(), F.lit(0)).otherwise(F.size("alert_list"))
                        .cast("int").alias("n_alerts"))


def q_all_alerts_exploded(spark, d):
    return explode_alerts(parsed(spark, d)).select("event_id", "sensor_id", EVENT_TIME, "alert_type")


def q_alert_counts_first_match(spark, d):
    return alert_counts(enriched(spark, d))


def q_alert_table(spark, d):
    return alert_table(enriched(spark, d))


def q_alert_messages(spark, d):
    return alert_messages(enriched(spark, d), keep=("event_id",))


def q_known_sensors(spark, d):
    return known(spark, d).select(*_READING_OUT)


def q_recent_window(spark, d):
    return recent(spark, d).select(*_READING_OUT)


STATE_COLUMNS = ["sensor_id", *READING_COLUMNS[2:], EVENT_TIME, "event_id"]


def q_latest_per_sensor(spark, d):
    return state(spark, d).select(*STATE_COLUMNS)


def q_recent_alerts(spark, d):
    return recent_alerts(spark, d)


def q_alert_gaps(spark, d):
    return alert_gaps(recent_alerts(spark, d)).select(*_GAP_OUT)


def q_incident_starts(spark, d):
    return incident_starts(recent_alerts(spark, d)).select(*_GAP_OUT)


def q_incident_sessions(spark, d):
    return incident_sessions(recent_alerts(spark, d))


def q_incident_counts(spark, d):
    return incident_counts(recent_alerts(spark, d))


def q_incident_total(spark, d):
    return incident_total(recent_alerts(spark, d))


def q_incident_counts_from_sessions(spark, d):
    """Counts over the horizon from whole-history sessions (no trimming): a
    session counts iff its last alert is inside the horizon."""
    k = known(spark, d)
    alerts = explode_alerts(k).select("event_id", "sensor_id", EVENT_TIME, "alert_type")
    return incidents_in_horizon(incident_sessions(alerts), as_of=latest_time(k))


def q_archive_json(spark, d):
    records = archive_json(enriched(spark, d), key_col="event_id")
    back = parse_archive(records).withColumn("event_id", F.col("key").cast("long"))
    return back.select("event_id", *ENRICHED_COLUMNS)


def q_publish_roundtrip(spark, d):
    msgs = reading_json(field_readings(events(spark, d)), key_col="event_id")
    return parse_readings(msgs, keep=("key",), with_event_time=False).select(
        F.col("key").cast("long").alias("event_id"), *READING_COLUMNS)


def q_control_state(spark, d):
    return control_state(field_control(events(spark, d)))


def q_batch_count(spark, d):
    # parsing drops no row, so messages are counted as they are (no column is read)
    return field_messages(events(spark, d), binary=True).agg(F.count(F.lit(1)).alias("n_rows"))


def _panel(fn):
    return lambda spark, d: fn(state(spark, d))


def queries() -> dict[str, Query]:
    return {
        "parse_readings": q_parse_readings,
        "normalise_readings": q_normalise_readings,
        "first_alert": q_first_alert,
        "all_alerts_list": q_all_alerts_list,
        "all_alerts_exploded": q_all_alerts_exploded,
        "alert_counts_first_match": q_alert_counts_first_match,
        "alert_table": q_alert_table,
        "alert_messages": q_alert_messages,
        "known_sensors": q_known_sensors,
        "recent_window": q_recent_window,
        "latest_per_sensor": q_latest_per_sensor,
        "panel_temperature": _panel(panel_temperature),
        "panel_humidity": _panel(panel_humidity),
        "panel_water": _panel(panel_water),
        "panel_motion": _panel(panel_motion),
        "panel_insects": _panel(panel_insects),
        "recent_alerts": q_recent_alerts,
        "alert_gaps": q_alert_gaps,
        "incident_starts": q_incident_starts,
        "incident_sessions": q_incident_sessions,
        "incident_counts": q_incident_counts,
        "incident_total": q_incident_total,
        "incident_counts_from_sessions": q_incident_counts_from_sessions,
        "archive_json": q_archive_json,
        "publish_roundtrip": q_publish_roundtrip,
        "control_state": q_control_state,
        "batch_count": q_batch_count,
    }
