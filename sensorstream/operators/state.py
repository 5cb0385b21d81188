"""Current state per sensor and the chart-ready panels built on it."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalise import measure
from ..functions.time import as_interval_micros, epoch_micros
from ..rules import ACTIVE_LEVEL, ALERT_HORIZON, IDLE_LEVEL, MOTION_SENSOR, PANEL_COLOURS, RULES, VALID_SENSORS
from ..schema import EVENT_DATE, EVENT_TIME


def known_sensors(df: DataFrame, sensors: Sequence[str] | DataFrame = VALID_SENSORS) -> DataFrame:
    """Whitelist filter (a null id is dropped).

    A list becomes an ``IN`` predicate, pushed to the scan when the source is
    a table. A registry DataFrame with a ``sensor_id`` column (a fleet too big
    for a literal list) becomes a left-semi join; Spark chooses broadcast or
    shuffle from its size.
    """
    if isinstance(sensors, DataFrame):
        return df.join(sensors.select("sensor_id").distinct(), "sensor_id", "left_semi")
    return df.filter(F.col("sensor_id").isin(list(sensors)))


def latest_time(df: DataFrame, col: str = EVENT_TIME) -> Column:
    """``max(col)`` of ``df`` as a scalar subquery (evaluated once, no join).

    On a history partitioned by ``event_date`` the last day is found first
    (partition column only) and the time is taken from that day's files: the
    outer filter prunes partitions at run time, so the whole table is not read.
    """
    if col == EVENT_TIME and EVENT_DATE in df.columns:
        last_day = df.select(F.max(EVENT_DATE)).scalar()
        return df.filter(F.col(EVENT_DATE) >= last_day).select(F.max(col)).scalar()
    return df.select(F.max(col)).scalar()


def recent_window(df: DataFrame, as_of: Column | None = None, horizon: str = ALERT_HORIZON) -> DataFrame:
    """Readings with ``event_time >= as_of - horizon`` (lower bound inclusive,
    no upper bound). ``as_of`` defaults to the current local wall clock."""
    as_of = F.localtimestamp() if as_of is None else as_of
    start = F.timestamp_add("MICROSECOND", F.lit(-as_interval_micros(horizon)), as_of)
    out = df.filter(F.col(EVENT_TIME) >= start)
    if EVENT_DATE in df.columns:
        # implied by the time bound; on a date-partitioned history it prunes files
        out = out.filter(F.col(EVENT_DATE) >= F.to_date(start))
    return out


_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_TWO_63 = Decimal(2 ** 63)
_TWO_64 = Decimal(2 ** 64)


def _order_key(tie_col: str) -> Column:
    """(event time, tie) packed into one exact ``decimal(38,0)``:
    micros * 2^64 + (tie + 2^63). Order-preserving, and a fixed-width
    aggregation buffer."""
    us = epoch_micros(EVENT_TIME).cast("decimal(38,0)")
    tie = F.coalesce(F.col(tie_col).cast("long"), F.lit(-(2 ** 63))).cast("decimal(38,0)")
    return us * F.lit(_TWO_64) + (tie + F.lit(_TWO_63))


def latest_per_sensor(df: DataFrame, tie_col: str | Sequence[str] = "event_id") -> DataFrame:
    """The most recent reading of every sensor.

    One aggregate with partial + final phases: each task reduces its rows to
    one per sensor before the shuffle, so a sensor that owns most rows costs
    no more than any other. Ties on ``event_time`` go to the larger
    ``tie_col``. Rows without a sensor id or a valid time are ignored.

    When every column is fixed-width and the tie is one column, each column
    is a ``max_by`` over one packed decimal key, which plans as
    ``HashAggregate``. A string column (e.g. the raw ``timestamp`` text) or a
    tie of several columns (Kafka: partition and offset) makes it one
    ``max_by`` over a struct, which Spark runs as ``SortAggregate`` (a local
    sort before the partial aggregate).
    """
    ties = [tie_col] if isinstance(tie_col, str) else list(tie_col)
    cols = [c for c in df.columns if c != "sensor_id"]
    rows = df.filter(F.col("sensor_id").isNotNull() & F.col(EVENT_TIME).isNotNull())
    if len(ties) == 1 and all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in cols):
        key = _order_key(ties[0])
        return rows.groupBy("sensor_id").agg(*[F.max_by(c, key).alias(c) for c in cols])
    order = F.struct(F.col(EVENT_TIME), *[F.col(t) for t in ties])
    return (
        rows.groupBy("sensor_id")
        .agg(F.max_by(F.struct(*cols), order).alias("_last"))
        .select("sensor_id", "_last.*")
    )


def update_latest_state(previous: DataFrame, new_readings: DataFrame,
                        tie_col: str | Sequence[str] = "event_id") -> DataFrame:
    """Fold new readings into a stored latest state (one row per sensor).

    Same answer as :func:`latest_per_sensor` over the whole history, but reads
    only the new readings (e.g. the latest partition) plus the small previous
    state, so a refresh does not rescan the history.
    """
    return latest_per_sensor(previous.unionByName(new_readings.select(*previous.columns)), tie_col)


def _in_alarm(col: str) -> Column:
    conds = []
    for r in RULES:
        if r.column == col:
            v, t = measure(col), F.lit(r.threshold)
            conds.append(v > t if r.op == ">" else v < t if r.op == "<" else v == t)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    return F.coalesce(cond, F.lit(False))


def _level_panel(state: DataFrame, col: str) -> DataFrame:
    alarm, normal = PANEL_COLOURS[col]
    flag = _in_alarm(col)
    return state.filter(F.col("sensor_id") != MOTION_SENSOR).select(
        "sensor_id", F.col(col).alias("value"), flag.alias("in_alarm"),
        F.when(flag, F.lit(alarm)).otherwise(F.lit(normal)).alias("colour"),
    )


def _binary_panel(state: DataFrame, col: str, motion: bool) -> DataFrame:
    on, grey = PANEL_COLOURS[col]
    v = F.col(col)
    rows = state.filter(F.col("sensor_id") == MOTION_SENSOR) if motion else state.filter(F.col("sensor_id") != MOTION_SENSOR)
    active = F.coalesce(v == 1.0, F.lit(False))
    return rows.select(
        "sensor_id",
        # a missing value draws as a full bar (only an explicit 0 is idle)
        F.when(F.coalesce(v == 0.0, F.lit(False)), F.lit(IDLE_LEVEL)).otherwise(F.lit(ACTIVE_LEVEL)).alias("value"),
        active.alias("in_alarm"),
        F.when(active, F.lit(on)).otherwise(F.lit(grey)).alias("colour"),
    )


def panel_temperature(state: DataFrame) -> DataFrame:
    return _level_panel(state, "temperature")


def panel_humidity(state: DataFrame) -> DataFrame:
    return _level_panel(state, "humidity")


def panel_water(state: DataFrame) -> DataFrame:
    return _level_panel(state, "waterQuality")


def panel_motion(state: DataFrame) -> DataFrame:
    return _binary_panel(state, "motion", motion=True)


def panel_insects(state: DataFrame) -> DataFrame:
    return _binary_panel(state, "insectPresence", motion=False)
