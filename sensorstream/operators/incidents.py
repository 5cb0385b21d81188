"""Incidents: alerts of one (sensor, type) merged while gaps stay <= ``gap``.

A ``lag`` window or a batch ``session_window`` would send every alert of one
(sensor, type) key to a single task; with a handful of sensors that is a
handful of tasks, and one busy sensor can own a third of the data.

Per-row gaps are a segmented scan: the alerts are range-sorted by key and time
into runs, a window works inside (run, key), and one row per run carries the
last alert to the next run (see ``runs``). No step holds a key whole, whatever
the gap.

Counts and sessions first cut time into cells exactly ``gap`` wide:

* two alerts in the same cell are less than ``gap`` apart, so only the first
  alert of a cell can open an incident;
* it opens one iff the previous cell is empty or its last alert is more than
  ``gap`` earlier.

So they need a per-cell aggregate (partial aggregation on the map side,
skew-proof) and the same scan over that summary, which a wide gap makes small
and a narrow one leaves distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import as_interval_micros, epoch_micros, from_epoch_micros
from ..rules import ALERT_HORIZON, INCIDENT_GAP
from ..schema import EVENT_TIME
from .runs import sorted_runs, with_owner, with_previous
from .state import recent_window

KEYS = ("sensor_id", "alert_type")


def _with_cell(alerts: DataFrame, gap_us: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Alerts with exact micros and cell number; alerts without a time or a
    key belong to no incident and are dropped."""
    us = epoch_micros(EVENT_TIME)
    valid = F.col(EVENT_TIME).isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    return (
        alerts.filter(valid)
        .withColumn("_us", us)
        .withColumn("_cell", F.expr(f"(_us - pmod(_us, {gap_us}L)) div {gap_us}L"))
    )


def cell_summary(alerts: DataFrame, gap: str = INCIDENT_GAP, keys: Sequence[str] = KEYS) -> DataFrame:
    """First/last alert time and count per (keys, gap-wide cell)."""
    gap_us = as_interval_micros(gap)
    return (
        _with_cell(alerts, gap_us, keys)
        .groupBy(*keys, "_cell")
        .agg(F.min("_us").alias("_first_us"), F.max("_us").alias("_last_us"),
             F.min(EVENT_TIME).alias("first_time"), F.max(EVENT_TIME).alias("last_time"),
             F.count(F.lit(1)).alias("n_alerts"))
    )


def cell_links(alerts: DataFrame, gap: str = INCIDENT_GAP, keys: Sequence[str] = KEYS) -> DataFrame:
    """Cell summary plus ``opens``: does the cell's first alert open an incident.

    The previous *non-empty* cell is enough: if it is older than the cell just
    before, its last alert is already more than ``gap`` away. The alerts are
    read and aggregated once; the scan runs over the compact summary.
    """
    runs = sorted_runs(cell_summary(alerts, gap, keys), keys, ["_cell"], "incident-cells", shuffled=True)
    linked = with_previous(runs, keys, "_last_us", "_prev_us")
    opens = F.col("_prev_us").isNull() | ((F.col("_first_us") - F.col("_prev_us")) > F.lit(as_interval_micros(gap)))
    return linked.withColumn("opens", opens).drop("_prev_us")


def incident_counts(alerts: DataFrame, gap: str = INCIDENT_GAP, keys: Sequence[str] = KEYS,
                    by: str = "alert_type") -> DataFrame:
    """Distinct incidents per ``by`` column (``n_incidents``), largest first."""
    return (
        cell_links(alerts, gap, keys).filter("opens")
        .groupBy(by).agg(F.count(F.lit(1)).alias("n_incidents"))
        .orderBy(F.desc("n_incidents"), F.asc(by))
    )


def incident_total(alerts: DataFrame, gap: str = INCIDENT_GAP, keys: Sequence[str] = KEYS) -> DataFrame:
    """Total number of distinct incidents (one row)."""
    return cell_links(alerts, gap, keys).agg(
        F.count_if(F.col("opens")).alias("n_incidents")
    )


def incident_sessions(alerts: DataFrame, gap: str = INCIDENT_GAP, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per incident: first and last alert time and alert count.

    Cells of one incident are consecutive, so each cell belongs to the latest
    opening cell at or before it.
    """
    owned = with_owner(cell_links(alerts, gap, keys), keys, "opens", "_incident")
    return (
        owned.groupBy(*keys, "_incident")
        .agg(F.min("first_time").alias("start_time"), F.max("last_time").alias("last_time"),
             F.sum("n_alerts").alias("n_alerts"))
        .drop("_incident")
    )


def _gaps(alerts: DataFrame, gap: str, keys: Sequence[str], tie_col: str) -> DataFrame:
    """Every alert with its predecessor's time (see :func:`alert_gaps`)."""
    gap_us = as_interval_micros(gap)
    others = [c for c in alerts.columns if c not in (*keys, EVENT_TIME, tie_col)]
    rows = _with_cell(alerts, gap_us, keys).drop("_cell")
    out = with_previous(sorted_runs(rows, keys, ["_us", tie_col], "alerts"), keys, "_us", "_p")
    return out.select(
        *keys, tie_col, *others, EVENT_TIME,
        F.when(F.col("_p").isNotNull(), from_epoch_micros("_p")).alias("prev_time"),
        ((F.col("_us") - F.col("_p")) / F.lit(1_000_000.0)).alias("time_diff"),
        (F.col("_p").isNull() | ((F.col("_us") - F.col("_p")) > F.lit(gap_us))).alias("_opens"),
        "_us",
    )


def alert_gaps(alerts: DataFrame, gap: str = INCIDENT_GAP, keys: Sequence[str] = KEYS,
               tie_col: str = "event_id") -> DataFrame:
    """Every alert with ``prev_time`` (previous alert of the same key, by
    ``(event_time, tie_col)``) and ``time_diff`` seconds; null for the first."""
    return _gaps(alerts, gap, keys, tie_col).drop("_opens", "_us")


def incident_starts(alerts: DataFrame, gap: str = INCIDENT_GAP, keys: Sequence[str] = KEYS,
                    tie_col: str = "event_id") -> DataFrame:
    """Alerts that open an incident: no previous alert, or gap > ``gap``."""
    return _gaps(alerts, gap, keys, tie_col).filter("_opens").drop("_opens", "_us")


def incidents_in_horizon(sessions: DataFrame, as_of: Column | None = None, horizon: str = ALERT_HORIZON) -> DataFrame:
    """Incident counts over a horizon from whole-history sessions, largest first.

    A session counts iff its last alert is inside the horizon: trimming the
    alerts first would leave a non-empty tail of exactly those sessions.
    """
    inside = recent_window(sessions.withColumn(EVENT_TIME, F.col("last_time")), as_of, horizon)
    counts = inside.groupBy("alert_type").agg(F.count(F.lit(1)).alias("n_incidents"))
    return counts.orderBy(F.desc("n_incidents"), F.asc("alert_type"))
