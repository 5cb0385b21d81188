"""Streaming jobs: archive, history, current state, incidents.

Every query needs a checkpoint location (at-least-once, restartable) and takes
an optional trigger; tests use ``{"availableNow": True}``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import parse_readings
from ..functions.time import from_instant, to_instant
from ..operators.alerts import explode_alerts, first_alert
from ..operators.incidents import incidents_in_horizon  # noqa: F401  (re-exported)
from ..operators.state import known_sensors, latest_per_sensor
from ..rules import ALERT_HORIZON, INCIDENT_GAP, VALID_SENSORS
from ..schema import EVENT_DATE, EVENT_TIME
from ..sources.config import ARCHIVE_TOPIC
from ..sources.sinks import write_archive, write_history
from .snapshots import refresh_state

EVENT_TS = "event_ts"  # event time as TIMESTAMP: watermarks reject TIMESTAMP_NTZ
DEFAULT_DELAY = "10 minutes"  # >= expected lateness + incident gap


def with_event_ts(readings: DataFrame, delay: str | None = DEFAULT_DELAY) -> DataFrame:
    """Add ``event_ts`` and, if ``delay`` is given, a watermark on it.

    Note: Catalyst pushes filters that do not use ``event_ts`` below the
    watermark, so the watermark advances only on rows that reach the stateful
    operator (for incidents: alerting readings of known sensors).
    """
    out = readings.withColumn(EVENT_TS, to_instant(EVENT_TIME))
    return out.withWatermark(EVENT_TS, delay) if delay else out


MESSAGE_KEY = "_message_key"


def with_message_key(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """A unique message key from the id columns (Kafka: ``partition:offset``)."""
    return df.withColumn(MESSAGE_KEY, F.concat_ws(":", *[F.col(c).cast("string") for c in keep]))


def archive_stream(messages: DataFrame, fmt: str = "kafka", target: str = ARCHIVE_TOPIC, options=None,
                   checkpoint: str | None = None, trigger: dict | None = None,
                   keep: Sequence[str] = ("event_id",)) -> StreamingQuery:
    """Parse, label and archive every reading; executors write the sink. The
    message key joins the ``keep`` id columns (none when ``keep`` is empty)."""
    enriched = first_alert(parse_readings(messages, keep=keep))
    if not keep:
        return write_archive(enriched, fmt, target, options, checkpoint, trigger)
    return write_archive(with_message_key(enriched, keep), fmt, target, options, checkpoint, trigger, MESSAGE_KEY)


def latest_state_stream(readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                        tie_col: str | Sequence[str] = "event_id", sensors=VALID_SENSORS) -> StreamingQuery:
    """Keep the latest reading per sensor as streaming state (update mode).

    The same aggregate as the batch :func:`latest_per_sensor` (state: one row
    per sensor, holding the parsed time). Each micro-batch writes only the
    sensors that changed, to ``path/run=ID/epoch=N`` (overwritten on replay, so
    idempotent); ID is the checkpoint's own, so a new checkpoint on the same
    log replaces nothing. Batches without changes write nothing. Read with
    :func:`read_latest_state`.
    """
    known = known_sensors(readings, sensors).drop("timestamp", EVENT_TS)
    agg = latest_per_sensor(known, tie_col)
    # an empty epoch carries the schema, so the log is readable before the first batch
    spark = readings.sparkSession
    spark.createDataFrame([], agg.schema).write.mode("overwrite").parquet(f"{path}/run=none/epoch=-1")
    run: list[str] = []

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()  # one row per changed sensor
        try:
            if not batch.isEmpty():
                if not run:
                    run.append(json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"])
                batch.write.mode("overwrite").parquet(f"{path}/run={run[0]}/epoch={epoch_id}")
        finally:
            batch.unpersist()

    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(upsert)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def _change_log(spark: SparkSession, path: str, snapshot: str | DataFrame | None) -> DataFrame:
    """The change log, or a snapshot and the epochs after those it holds.

    The snapshot's last epoch of each run is read on the driver (a row per
    checkpoint ever used), so that the filter prunes folders."""
    log = spark.read.parquet(path)
    if snapshot is None:
        return log
    snap = spark.read.parquet(snapshot) if isinstance(snapshot, str) else snapshot
    newer = F.lit(True)
    for run, epoch in snap.groupBy("run").agg(F.max("epoch")).collect():
        newer = newer & ((F.col("run") != run) | (F.col("epoch") > epoch))
    return snap.unionByName(log.filter(newer).select(*snap.columns))


def _newest(log: DataFrame, tie_col: str | Sequence[str] | None) -> DataFrame:
    """Per sensor the log's row of the latest reading, whichever run or epoch wrote it."""
    if tie_col is None:
        tie_col = ("partition", "offset") if "offset" in log.columns else "event_id"
    return latest_per_sensor(log, tie_col)


def read_latest_state(spark: SparkSession, path: str, snapshot: str | None = None,
                      tie_col: str | Sequence[str] | None = None) -> DataFrame:
    """Current state from the change log: per sensor, its latest reading by
    event time, then ids (``tie_col``; default: the log's partition and offset,
    else event_id).

    With ``snapshot`` (written by :func:`compact_latest_state`) only the
    epochs after the snapshot's are read from the log.
    """
    return _newest(_change_log(spark, path, snapshot), tie_col).drop("run", "epoch")


def compact_latest_state(spark: SparkSession, path: str, snapshot: str, previous: str | None = None,
                         tie_col: str | Sequence[str] | None = None) -> None:
    """Write the current state (one row per sensor, with the run and epoch it
    came from) to ``snapshot``. Later reads pass ``snapshot=`` and skip older epoch
    folders, which a retention policy can then expire."""
    if previous is not None and previous.rstrip("/") == snapshot.rstrip("/"):
        raise ValueError("a snapshot cannot replace the one it is made from: write it to a new folder")
    _newest(_change_log(spark, path, previous), tie_col).write.mode("overwrite").parquet(snapshot)


def refresh_latest_state(spark: SparkSession, path: str, snapshots: str,
                         tie_col: str | Sequence[str] | None = None) -> DataFrame:
    """Current state, compacted on the way: a new version is written under
    ``snapshots`` from the newest one there and the epochs after it, so each
    refresh reads only what changed since the last. Nothing expires (see
    :func:`snapshots.refresh_state`). Returns the new version."""
    return refresh_state(spark, path, snapshots, tie_col, expire=False)


def incident_sessions_stream(readings: DataFrame, gap: str = INCIDENT_GAP, sensors=VALID_SENSORS) -> DataFrame:
    """Incidents as session windows per (sensor, alert type), append mode.

    ``readings`` must carry a watermark on ``event_ts`` (:func:`with_event_ts`).
    A session is emitted once the watermark passes its end (last alert + gap);
    state holds only open sessions.
    """
    return _sessions(readings, gap, sensors).select(
        "sensor_id", "alert_type", from_instant("_start").alias("start_time"), from_instant("_last").alias("last_time"), "n_alerts")


def _sessions(readings: DataFrame, gap: str, sensors) -> DataFrame:
    alerts = explode_alerts(known_sensors(readings, sensors))
    return (
        alerts.groupBy(F.session_window(EVENT_TS, gap).alias("w"), "sensor_id", "alert_type")
        .agg(F.min(EVENT_TS).alias("_start"), F.max(EVENT_TS).alias("_last"), F.count(F.lit(1)).alias("n_alerts"))
    )


def rolling_incident_counts_stream(readings: DataFrame, gap: str = INCIDENT_GAP, horizon: str = ALERT_HORIZON, every: str = "1 hour",
                                   sensors=VALID_SENSORS) -> DataFrame:
    """Incidents per alert type in windows of ``horizon``, one starting each ``every``, append mode.

    Two chained stateful operators on one watermark: session windows, then
    their count by the window that holds their end (last alert + gap). State:
    open incidents and one counter per alert type and open window; the second
    operator pre-aggregates in each task, so a busy sensor sends counters.
    ``readings`` must carry a watermark on ``event_ts``; a window is emitted
    once the watermark passes its end.
    """
    ends = _sessions(readings, gap, sensors).select("alert_type", F.window_time("w").alias("_end"))
    return (
        ends.groupBy(F.window("_end", horizon, every).alias("h"), "alert_type").agg(F.count(F.lit(1)).alias("n_incidents"))
        .select(from_instant("h.start").alias("window_start"), from_instant("h.end").alias("window_end"), "alert_type", "n_incidents")
    )


def start_archive_and_history(messages: DataFrame, history_target: str, checkpoint_root: str,
                              archive_fmt: str = "kafka", archive_target: str = ARCHIVE_TOPIC,
                              archive_options: dict | None = None, history_fmt: str = "parquet",
                              trigger: dict | None = None, keep: Sequence[str] = ("event_id",),
                              history_partition: tuple[str, ...] = (EVENT_DATE,)) -> list[StreamingQuery]:
    """Two queries on one parsed stream: raw history and labelled archive.

    Each query has its own checkpoint under ``checkpoint_root`` and reads the
    source on its own. History files are partitioned by ``history_partition``
    (none for the memory sink). Returns both handles; stop them with
    :func:`stop_all`.
    """
    readings = parse_readings(messages, keep=keep)
    hist = write_history(readings, history_target, history_fmt,
                         checkpoint=f"{checkpoint_root}/history", trigger=trigger,
                         partition_by=() if history_fmt == "memory" else history_partition)
    enriched = with_message_key(first_alert(readings), keep) if keep else first_alert(readings)
    arch = write_archive(enriched, archive_fmt, archive_target, archive_options,
                         f"{checkpoint_root}/archive", trigger, MESSAGE_KEY if keep else None)
    return [hist, arch]


def stop_all(queries) -> None:
    """Stop every query, even if one of them fails to stop."""
    errors = []
    for q in queries:
        try:
            q.stop()
        except Exception as e:  # keep stopping the others
            errors.append(e)
    if errors:
        raise errors[0]


def watermark_of(query: StreamingQuery) -> str | None:
    """The event-time watermark of the query's last micro-batch (ISO text without a zone), None before the first."""
    progress = query.lastProgress
    mark = (progress["eventTime"] if progress else {}).get("watermark")
    return mark.rstrip("Z") if mark else None


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that stateful operators discarded as too late (recent progress)."""
    return sum(op.get("numRowsDroppedByWatermark", 0) or 0
               for p in query.recentProgress for op in p.get("stateOperators", []))


def start_dashboard_job(messages: DataFrame, root: str, archive_fmt: str = "kafka",
                        archive_target: str = ARCHIVE_TOPIC, archive_options: dict | None = None,
                        trigger: dict | None = None, delay: str = DEFAULT_DELAY, gap: str = INCIDENT_GAP,
                        keep: Sequence[str] = ("event_id",), sensors=VALID_SENSORS) -> dict[str, StreamingQuery]:
    """The dashboard job as streaming queries on one message stream.

    ``history`` (raw readings, parquet by day), ``archive`` (labelled JSON),
    ``latest`` (state per sensor, change log) and ``sessions`` (closed
    incidents by day of their last alert, append after the watermark), each
    with its own checkpoint under ``root``. Panels are batch reads of
    ``latest`` and of the history inside the horizon, which also holds late
    rows and incidents still open; ``sessions`` is the record of closed ones.
    ``keep`` must name columns that identify a message (the tie-breaker for
    equal times): ``("partition", "offset")`` for Kafka.
    """
    if not keep:
        raise ValueError("keep must identify a message, e.g. ('partition', 'offset') for Kafka")
    readings = parse_readings(messages, keep=keep)
    queries = dict(zip(("history", "archive"), start_archive_and_history(
        messages, f"{root}/history", f"{root}/checkpoints", archive_fmt, archive_target, archive_options,
        trigger=trigger, keep=keep)))
    queries["latest"] = latest_state_stream(readings, f"{root}/latest", f"{root}/checkpoints/latest", trigger,
                                            keep[0] if len(keep) == 1 else tuple(keep), sensors)
    sessions = incident_sessions_stream(with_event_ts(readings, delay), gap, sensors)
    w = (sessions.withColumn(EVENT_DATE, F.to_date("last_time")).writeStream.format("parquet").partitionBy(EVENT_DATE).option("checkpointLocation", f"{root}/checkpoints/sessions")
         .outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    queries["sessions"] = w.start(f"{root}/sessions")
    return queries
