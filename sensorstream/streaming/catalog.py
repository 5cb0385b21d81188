"""Streaming queries for the driver catalog.

Each one replays ``events`` through a streaming query with an
``availableNow`` trigger, six or more files out of order and one per
micro-batch, into a table under the checkpoint root, then returns that table;
results must equal the batch twins (same DuckDB oracles).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonio import parse_archive
from ..functions.parse import parse_readings
from ..functions.time import as_interval_micros
from ..plans import catalog as batch
from ..plans.oracles import GAPS, KNOWN, _BASE, _exploded, _with, oracle_sql
from ..operators.state import latest_time
from ..rules import INCIDENT_GAP
from ..schema import ENRICHED_COLUMNS, EVENT_DATE, EVENT_TIME
from ..session import scratch_path
from ..sources.fixtures import events, field_control, field_messages
from ..sources.readers import MESSAGE_SCHEMA
from ..sources.sinks import write_history
from .control import control_state_stream
from .jobs import (archive_stream, incident_sessions_stream, incidents_in_horizon, latest_state_stream,
                   read_latest_state, rolling_incident_counts_stream, watermark_of, with_event_ts)
from .late import late_rows_stream, read_sessions, recount_late
from .live import STATE_STORE, current_incidents, live_incidents
from .metrics import RunMetrics, counted, run_totals
from .replay import append_closing, message_files, time_files

NOW = {"availableNow": True}


#: The least delay of a stream that drops no row.
WIDE_DELAY = "10 days"


def _replay(spark: SparkSession, d: str, closing: bool = False) -> tuple[DataFrame, int]:
    """All messages over several micro-batches, out of order, and by how many seconds one may be late; ``closing``: then two batches that end every window."""
    files = message_files(field_messages(events(spark, d), keep=("rts",)), "rts")
    if closing:
        append_closing(spark, files.path, files.files)
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", str(files.files)).parquet(files.path), files.late_seconds


def _message_stream(spark: SparkSession, d: str) -> DataFrame:
    return _replay(spark, d)[0]


def _wide_readings(spark: SparkSession, d: str, closing: bool = False) -> DataFrame:
    """Readings with a watermark that no row is older than when it arrives."""
    stream, late = _replay(spark, d, closing)
    wide = max(late, as_interval_micros(WIDE_DELAY) // 1_000_000)
    return with_event_ts(parse_readings(stream, keep=("event_id",)), f"{wide} seconds")


def _run(df: DataFrame, spark: SparkSession, name: str, mode: str = "append") -> DataFrame:
    out, ck = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    q = df.writeStream.format("parquet").option("checkpointLocation", ck).outputMode(mode).trigger(**NOW).start(out)
    q.awaitTermination()
    return spark.read.parquet(out)


def stream_archive(spark: SparkSession, d: str) -> DataFrame:
    out, ck = scratch_path(spark, "archive"), scratch_path(spark, "archive-checkpoint")
    q = archive_stream(_message_stream(spark, d), fmt="parquet", target=out, checkpoint=ck, trigger=NOW)
    q.awaitTermination()
    back = parse_archive(spark.read.parquet(out)).withColumn("event_id", F.col("key").cast("long"))
    return back.select("event_id", *ENRICHED_COLUMNS)


def stream_latest_per_sensor(spark: SparkSession, d: str) -> DataFrame:
    path, ck = scratch_path(spark, "latest"), scratch_path(spark, "latest-checkpoint")
    readings = parse_readings(_message_stream(spark, d), keep=("event_id",))
    latest_state_stream(readings, path, ck, NOW).awaitTermination()
    return read_latest_state(spark, path).select(*batch.STATE_COLUMNS)


def _stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    readings = _wide_readings(spark, d, closing=True)
    return _run(incident_sessions_stream(readings), spark, "sessions")


def stream_incident_sessions(spark: SparkSession, d: str) -> DataFrame:
    return _stream_sessions(spark, d)


def stream_incident_counts(spark: SparkSession, d: str) -> DataFrame:
    sessions = _stream_sessions(spark, d)
    return incidents_in_horizon(sessions, as_of=latest_time(batch.known(spark, d)))


def stream_open_incidents(spark: SparkSession, d: str) -> DataFrame:
    """Every incident of the live change table after the last micro-batch, and whether it is open at the data's end."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    readings = _wide_readings(own, d)
    path, ck = scratch_path(spark, "live"), scratch_path(spark, "live-checkpoint")
    q = live_incidents(readings).writeStream.format("parquet").option("checkpointLocation", ck).trigger(**NOW).start(path)
    q.awaitTermination()
    found = current_incidents(spark.read.parquet(path))
    end = F.timestamp_add("MICROSECOND", F.lit(-as_interval_micros(INCIDENT_GAP)), latest_time(batch.known(spark, d)))
    return found.select("sensor_id", "alert_type", "start_time", "last_time", "n_alerts", (F.col("last_time") >= end).alias("is_open"))


def stream_rolling_incident_counts(spark: SparkSession, d: str) -> DataFrame:
    """Incidents per alert type in 12 h windows, one starting every hour."""
    readings = _wide_readings(spark, d, closing=True)
    return _run(rolling_incident_counts_stream(readings), spark, "rolling-counts")


def stream_late_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Incidents of a stream whose watermark drops late rows, corrected from the history.

    The delay is an hour and files overlap by days, so a fifth of the rows is late.
    """
    root = scratch_path(spark, "late")
    stream = _message_stream(spark, d)
    readings = parse_readings(stream, keep=("event_id",))
    delay = "1 hour"
    queries = [
        write_history(readings, f"{root}/history", checkpoint=f"{root}/ck/history", trigger=NOW, partition_by=(EVENT_DATE,)),
        late_rows_stream(readings, f"{root}/late", f"{root}/ck/late", delay, NOW),
        incident_sessions_stream(with_event_ts(readings, delay)).writeStream.format("parquet").option("checkpointLocation", f"{root}/ck/sessions").trigger(**NOW).start(f"{root}/sessions"),
    ]
    for q in queries:
        q.awaitTermination()
    history = spark.read.parquet(f"{root}/history")
    # what the stream had not closed when it ended is as good as late
    rest = history.where(F.col(EVENT_TIME) >= F.lit(watermark_of(queries[2])).cast("timestamp_ntz") - F.expr("interval 1 day"))
    rest.drop(EVENT_DATE).write.parquet(f"{root}/late/rows/epoch={2 ** 40}")
    recount_late(spark, history, f"{root}/late", f"{root}/sessions", f"{root}/corrections")
    return read_sessions(spark, f"{root}/sessions", f"{root}/corrections")


def stream_run_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the archive stream over its whole run, counted on the write itself."""
    listener = RunMetrics()
    spark.streams.addListener(listener)
    try:
        rows = counted(parse_readings(_message_stream(spark, d), keep=("event_id",)))
        q = rows.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "metrics-checkpoint")).trigger(**NOW).start(scratch_path(spark, "metrics"))
        q.awaitTermination()
        listener.wait_for(q)
        found = run_totals(listener.table(spark).where(F.col("query") == str(q.id)))
    finally:
        spark.streams.removeListener(listener)
    return found.select("rows_in", "rows_written", "rows_dropped")


def stream_control_state(spark: SparkSession, d: str) -> DataFrame:
    # a controller's input is in time order from file to file, in any order inside one
    path, kind = time_files(field_control(events(spark, d)), EVENT_TIME)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", "1").parquet(path)
    return _run(control_state_stream(stream), spark, "control")


def stream_queries():
    return {
        "stream_archive": stream_archive,
        "stream_latest_per_sensor": stream_latest_per_sensor,
        "stream_incident_sessions": stream_incident_sessions,
        "stream_incident_counts": stream_incident_counts,
        "stream_open_incidents": stream_open_incidents,
        "stream_late_sessions": stream_late_sessions,
        "stream_rolling_incident_counts": stream_rolling_incident_counts,
        "stream_run_metrics": stream_run_metrics,
        "stream_control_state": stream_control_state,
    }


def stream_oracles() -> dict[str, str]:
    sql = oracle_sql()
    whole = _with(*_BASE, KNOWN, _exploded("known", "alerts"), GAPS) + """,
s AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY sensor_id, alert_type
      ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM gaps2)
SELECT sensor_id, alert_type, min(event_time) AS start_time, max(event_time) AS last_time, count(*) AS n_alerts
FROM s GROUP BY sensor_id, alert_type, sid"""
    return {
        "stream_archive": sql["archive_json"],
        "stream_latest_per_sensor": sql["latest_per_sensor"],
        "stream_incident_sessions": whole,
        "stream_incident_counts": sql["incident_counts"],
        "stream_open_incidents": whole.replace("count(*) AS n_alerts", "count(*) AS n_alerts,\n"
                                               "       max(event_time) >= (SELECT max(event_time) FROM known) - INTERVAL 60 SECOND AS is_open"),
        "stream_late_sessions": whole,
        "stream_rolling_incident_counts": f"""WITH incident AS ({whole}),
ended AS (SELECT alert_type, last_time + INTERVAL 60 SECOND - INTERVAL 1 MICROSECOND AS e FROM incident),
held AS (SELECT alert_type, date_trunc('hour', e) - INTERVAL 1 HOUR * k AS window_start FROM ended, range(12) hours(k))
SELECT window_start, window_start + INTERVAL 12 HOUR AS window_end, alert_type, count(*) AS n_incidents
FROM held GROUP BY window_start, alert_type""",
        "stream_run_metrics": "SELECT count(*) AS rows_in, count(*) AS rows_written, 0::BIGINT AS rows_dropped FROM events",
        "stream_control_state": sql["control_state"],
    }
