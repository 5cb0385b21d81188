"""Composed batch plans: the archive job and the dashboard refresh.

Each function returns lazy DataFrames; Catalyst plans each output as one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from ..functions.jsonio import archive_json
from ..functions.parse import parse_readings
from ..operators.alerts import alert_messages, alert_table, explode_alerts, first_alert
from ..operators.incidents import incident_counts, incident_total
from ..operators.state import (known_sensors, latest_per_sensor, latest_time, panel_humidity, panel_insects,
                               panel_motion, panel_temperature, panel_water, recent_window)
from ..rules import ALERT_HORIZON, INCIDENT_GAP, VALID_SENSORS


def enrich(messages: DataFrame, keep=("event_id",)) -> DataFrame:
    """Messages -> parsed readings + first broken rule (archive record)."""
    return first_alert(parse_readings(messages, keep=keep))


@dataclass
class ArchiveOutputs:
    archive: DataFrame  # key/value JSON records, one per reading
    table: DataFrame  # display rows of alerting readings
    messages: DataFrame  # one notification per alerting reading


def archive_plan(messages: DataFrame, key_col: str = "event_id") -> ArchiveOutputs:
    enriched = enrich(messages, keep=(key_col,))
    return ArchiveOutputs(archive_json(enriched, key_col), alert_table(enriched), alert_messages(enriched, keep=(key_col,)))


@dataclass
class Dashboard:
    state: DataFrame
    temperature: DataFrame
    humidity: DataFrame
    water: DataFrame
    motion: DataFrame
    insects: DataFrame
    alerts: DataFrame  # exploded alerts inside the horizon
    incidents: DataFrame  # incidents per alert type
    total: DataFrame  # one row


def dashboard(readings: DataFrame, as_of: Column | None = None, horizon: str = ALERT_HORIZON,
              gap: str = INCIDENT_GAP, tie_col: str = "event_id", state: DataFrame | None = None,
              sensors=VALID_SENSORS) -> Dashboard:
    """All dashboard outputs from typed readings (known sensors only).

    ``as_of`` defaults to the wall clock; pass ``latest_time(...)`` to anchor the
    horizon to the data. Pass a stored ``state`` (streaming state or
    ``update_latest_state``) so a refresh reads only the horizon: on a
    date-partitioned history that is the last day's partitions. ``sensors`` is
    the whitelist: a list, or a registry DataFrame with ``sensor_id``.
    """
    known = known_sensors(readings, sensors)
    if state is None:
        state = latest_per_sensor(known.drop("timestamp"), tie_col)
    else:
        state = known_sensors(state, sensors)
    recent = recent_window(known, as_of, horizon)
    alerts = explode_alerts(recent)
    return Dashboard(
        state, panel_temperature(state), panel_humidity(state), panel_water(state), panel_motion(state),
        panel_insects(state), alerts, incident_counts(alerts, gap), incident_total(alerts, gap),
    )


def data_anchored_dashboard(readings: DataFrame, **kw) -> Dashboard:
    """Dashboard with the horizon ending at the latest known-sensor reading."""
    return dashboard(readings, as_of=latest_time(known_sensors(readings, kw.get("sensors", VALID_SENSORS))), **kw)


def write_dashboard(dash: Dashboard, root: str) -> None:
    """Write every panel and the incident tables under ``root`` (one parquet
    table each, replaced on every refresh) for a BI tool to plot. State and
    panels, a row per sensor, are sorted by sensor."""
    for name in ("state", "temperature", "humidity", "water", "motion", "insects"):
        getattr(dash, name).orderBy("sensor_id").write.mode("overwrite").parquet(f"{root}/{name}")
    for name in ("alerts", "incidents", "total"):
        getattr(dash, name).write.mode("overwrite").parquet(f"{root}/{name}")
