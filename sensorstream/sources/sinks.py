"""Sinks: archive, publish, history, per-batch callbacks.

All writers run on the executors (no ``collect``), require a checkpoint for
streams and let errors propagate, so delivery is at-least-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import functions as F

from ..functions.jsonio import archive_json, reading_json
from ..schema import EVENT_DATE, EVENT_TIME
from .config import ARCHIVE_TOPIC, INPUT_TOPIC


def kafka_sink_options(options: dict | None, topic: str) -> dict:
    """Source options (from :func:`kafka_options`) turned into sink options:
    the topic is set, subscription settings are dropped."""
    out = {k: v for k, v in (options or {}).items() if k not in ("subscribe", "startingOffsets")}
    out.setdefault("topic", topic)
    return out


def _write(df: DataFrame, fmt: str, path_or_topic: str | None, options: dict | None,
           checkpoint: str | None, trigger: dict | None, mode: str = "append") -> StreamingQuery | None:
    options = dict(options or {})
    if fmt == "kafka":
        options = kafka_sink_options(options, path_or_topic)
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming sink needs a checkpoint location")
        w = df.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint).outputMode(mode)
        if trigger:
            w = w.trigger(**trigger)
        return w.start(path_or_topic) if fmt != "kafka" and path_or_topic else w.start()
    w = df.write.format(fmt).options(**options)
    if fmt == "kafka":
        w.save()
    else:
        w.mode("append").save(path_or_topic)
    return None


def write_archive(enriched: DataFrame, fmt: str = "kafka", target: str = ARCHIVE_TOPIC,
                  options: dict | None = None, checkpoint: str | None = None,
                  trigger: dict | None = None, key_col: str | None = None):
    """Archive every enriched reading as JSON (all nine keys, nulls explicit)."""
    return _write(archive_json(enriched, key_col), fmt, target, options, checkpoint, trigger)


def publish_readings(readings: DataFrame, fmt: str = "kafka", target: str = INPUT_TOPIC,
                     options: dict | None = None, checkpoint: str | None = None,
                     trigger: dict | None = None, key_col: str | None = None):
    """Publish readings as JSON messages, batch or stream."""
    return _write(reading_json(readings, key_col), fmt, target, options, checkpoint, trigger)


def write_history(readings: DataFrame, name_or_path: str, fmt: str = "parquet",
                  checkpoint: str | None = None, trigger: dict | None = None,
                  partition_by: tuple[str, ...] = ()):
    """Append raw readings to a table. ``fmt="memory"`` keeps them in the
    driver under a query name (tests only); for real history use a parquet
    path partitioned by ``event_date`` (added from ``event_time`` when asked
    for and missing): ``recent_window`` then prunes whole days."""
    if EVENT_DATE in partition_by and EVENT_DATE not in readings.columns:
        readings = readings.withColumn(EVENT_DATE, F.to_date(EVENT_TIME))
    if fmt == "memory":
        w = readings.writeStream.format("memory").queryName(name_or_path).outputMode("append")
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        if trigger:
            w = w.trigger(**trigger)
        return w.start()
    if partition_by:
        if readings.isStreaming:
            if not checkpoint:
                raise ValueError("a streaming sink needs a checkpoint location")
            w = (readings.writeStream.format(fmt).partitionBy(*partition_by)
                 .option("checkpointLocation", checkpoint).outputMode("append"))
            if trigger:
                w = w.trigger(**trigger)
            return w.start(name_or_path)
        readings.write.format(fmt).partitionBy(*partition_by).mode("append").save(name_or_path)
        return None
    return _write(readings, fmt, name_or_path, None, checkpoint, trigger)


def for_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                   trigger: dict | None = None, mode: str = "append", persist: bool = False) -> StreamingQuery:
    """Run ``fn(batch_df, epoch_id)`` per micro-batch; empty batches skipped.

    Errors raised by ``fn`` fail the query, so the batch is replayed from the
    checkpoint on restart instead of being lost. ``persist`` caches the batch
    around ``fn`` (worth it only when ``fn`` runs more than one action on it).
    """
    if not checkpoint:
        raise ValueError("foreachBatch needs a checkpoint location")

    def guarded(batch: DataFrame, epoch_id: int) -> None:
        if persist:
            batch.persist()
        try:
            if not batch.isEmpty():
                fn(batch, epoch_id)
        finally:
            if persist:
                batch.unpersist()

    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(guarded)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
