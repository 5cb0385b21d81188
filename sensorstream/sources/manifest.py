"""Reading history with a manifest: its horizon is known without reading it.

``append_history`` writes typed readings by day under
``root/data/run=R/epoch=E/event_date=D`` and, next to them, what they hold:
``root/manifest/run=R/epoch=E`` has the least and greatest time and the row
count per day and sensor. An epoch is overwritten when it is replayed, so both
are idempotent; a manifest is written after its data, so it never names rows
that are not there. ``recent_history`` takes the end of the horizon from the
manifest and reads the horizon's days only.
"""

from __future__ import annotations

import datetime as dt
import json
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import as_interval_micros
from ..operators.state import known_sensors, recent_window
from ..rules import ALERT_HORIZON, VALID_SENSORS
from ..schema import EVENT_DATE, EVENT_TIME

_MANIFEST = "event_date date, sensor_id string, least timestamp_ntz, greatest timestamp_ntz, n_rows long"


def append_history(readings: DataFrame, root: str, run: str = "batch", epoch: int | None = None) -> None:
    """Write readings and their manifest as one epoch (default: a new one)."""
    spark = readings.sparkSession
    epoch = time.time_ns() if epoch is None else epoch
    at = f"run={run}/epoch={epoch}"
    rows = readings.withColumn(EVENT_DATE, F.to_date(EVENT_TIME))
    # few files a day; a day larger than a partition is split again at run time
    rows.hint("rebalance", EVENT_DATE).write.mode("overwrite").partitionBy(EVENT_DATE).parquet(f"{root}/data/{at}")
    try:
        held = spark.read.schema(rows.schema).parquet(f"{root}/data/{at}")
    except AnalysisException as e:  # no row, so no file
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        held = rows.limit(0)
    entries = held.groupBy(EVENT_DATE, "sensor_id").agg(
        F.min(EVENT_TIME).alias("least"), F.max(EVENT_TIME).alias("greatest"), F.count(F.lit(1)).alias("n_rows"))
    entries.write.mode("overwrite").parquet(f"{root}/manifest/{at}")


def history_stream(readings: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append every micro-batch of a stream to a history with a manifest."""
    run: list[str] = []

    def append(batch: DataFrame, epoch: int) -> None:
        if not run:  # the checkpoint's own id: another checkpoint on the same history replaces nothing
            run.append(json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        append_history(batch, root, run[0], epoch)

    w = readings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Per run, epoch, day and sensor: least and greatest time, row count."""
    return spark.read.schema(f"{_MANIFEST}, run string, epoch long").parquet(f"{root}/manifest")


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All readings of the history (with ``run``, ``epoch`` and ``event_date``)."""
    return spark.read.parquet(f"{root}/data")


def history_end(spark: SparkSession, root: str, sensors=VALID_SENSORS) -> dt.datetime | None:
    """Time of the latest reading of a known sensor: one value, from the manifest alone."""
    return known_sensors(manifest(spark, root), sensors).agg(F.max("greatest")).first()[0]


def history_count(spark: SparkSession, root: str) -> int:
    """Rows of the history, from the manifest alone."""
    return manifest(spark, root).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def recent_history(spark: SparkSession, root: str, horizon: str = ALERT_HORIZON, sensors=VALID_SENSORS,
                   as_of: dt.datetime | None = None) -> DataFrame:
    """Known sensors' readings in the horizon that ends at ``as_of`` (default: :func:`history_end`).

    The bounds are literals, so the scan takes the days' folders only and the
    files' statistics skip what lies before the horizon.
    """
    end = as_of or history_end(spark, root, sensors)
    known = known_sensors(read_history(spark, root), sensors)
    if end is None:
        return known.limit(0)
    start = end - dt.timedelta(microseconds=as_interval_micros(horizon))
    days = F.col(EVENT_DATE) >= F.lit(start.date())
    return recent_window(known.where(days & (F.col(EVENT_TIME) >= F.lit(start))), F.lit(end), horizon)
