"""Late rows: kept in a side table, and the incidents they touch counted again.

A watermark drops rows older than the stream's latest time less the delay. The
history keeps them, but the table of closed incidents misses them. Three parts
mend that:

* :func:`late_rows_stream` copies every row that may have been dropped to a
  side table: those older than the latest time *up to and including* their
  micro-batch less the delay. Other queries on the same source may cut it into
  other micro-batches; whatever they had seen before a row, this one has too,
  so its table holds at least what they dropped.
* :func:`recount_late` counts again from the history, for the (sensor, type,
  day) ranges that new late rows touch and no others, widened to whole
  incidents, and appends corrections: a row of weight -1 for an incident that
  is not there any more, +1 for one that is new.
* :func:`read_sessions` adds the corrections to the closed incidents.

A recount is repeatable: a row that was not late after all gives no correction,
and one recount run twice gives the same table.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import as_interval_micros
from ..operators.alerts import explode_alerts
from ..operators.incidents import incident_sessions
from ..operators.runs import written
from ..operators.state import known_sensors
from ..rules import INCIDENT_GAP, VALID_SENSORS
from ..schema import EVENT_DATE, EVENT_TIME

KEYS = ("sensor_id", "alert_type")
SESSION = (*KEYS, "start_time", "last_time", "n_alerts")
_SESSION_SQL = "sensor_id string, alert_type string, start_time timestamp_ntz, last_time timestamp_ntz, n_alerts long"


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def late_rows_stream(readings: DataFrame, path: str, checkpoint: str, delay: str, trigger: dict | None = None) -> StreamingQuery:
    """Write rows that a watermark of ``delay`` may have dropped to ``path/rows/epoch=N``.

    ``path/seen/epoch=N`` holds a row per micro-batch, its latest time; both are
    overwritten when a micro-batch is replayed. ``readings`` must not carry a
    watermark itself.
    """
    micros = as_interval_micros(delay)

    def collect(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        seen = batch.agg(F.max(EVENT_TIME).alias("latest"))
        seen.write.mode("overwrite").parquet(f"{path}/seen/epoch={epoch}")
        latest = _read(spark, f"{path}/seen", "latest timestamp_ntz, epoch long").where(F.col("epoch") <= epoch).agg(F.max("latest")).scalar()
        limit = F.timestamp_add("MICROSECOND", F.lit(-micros), latest)
        batch.where(F.col(EVENT_TIME) < limit).write.mode("overwrite").parquet(f"{path}/rows/epoch={epoch}")

    w = readings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(collect)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_sessions(spark: SparkSession, sessions: str, corrections: str) -> DataFrame:
    """Closed incidents with all corrections: those whose weights add up to one."""
    base = _read(spark, sessions, _SESSION_SQL).withColumn("weight", F.lit(1))
    fixes = _read(spark, corrections, f"{_SESSION_SQL}, weight int").select(*SESSION, "weight")
    return base.unionByName(fixes).groupBy(*SESSION).agg(F.sum("weight").alias("_w")).where("_w > 0").drop("_w")


def _days(frame: DataFrame, lo: str, hi: str, name: str) -> DataFrame:
    """A row per day that the interval touches."""
    return frame.withColumn(name, F.explode(F.sequence(F.to_date(lo), F.to_date(hi), F.expr("interval 1 day"))))


def _ranges(touched: DataFrame, current: DataFrame, gap_us: int) -> DataFrame:
    """(keys, lo, hi): the touched days, widened to whole incidents; overlapping ones of a key made one."""
    add = lambda c, us: F.timestamp_add("MICROSECOND", F.lit(us), F.col(c))
    days = touched.select(*KEYS, F.col("day").cast("timestamp_ntz").alias("begin")).withColumn("end", F.col("begin") + F.expr("interval 1 day"))
    days = days.select(*KEYS, add("begin", -gap_us).alias("lo"), add("end", gap_us).alias("hi"))
    wide = _days(days, "lo", "hi", "_d").join(_days(current, "start_time", "last_time", "_d"), [*KEYS, "_d"], "left")
    met = (F.col("start_time") <= F.col("hi")) & (F.col("last_time") >= F.col("lo"))
    wide = wide.groupBy(*KEYS, "lo", "hi").agg(F.min(F.when(met, add("start_time", -gap_us))).alias("_s"), F.max(F.when(met, add("last_time", gap_us))).alias("_l"))
    wide = wide.select(*KEYS, F.least("lo", "_s").alias("lo"), F.greatest("hi", "_l").alias("hi"))
    by_time = Window.partitionBy(*KEYS).orderBy("lo", "hi")  # a row per touched day of the key
    before = F.max("hi").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    own = wide.withColumn("_new", F.when(before.isNull() | (F.col("lo") > before), 1).otherwise(0))
    own = own.withColumn("_no", F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return own.groupBy(*KEYS, "_no").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_no")


def _inside(rows: DataFrame, ranges: DataFrame, day: str, at: str) -> DataFrame:
    """Rows of a range: met by key and day, so a day-partitioned table reads only the ranges' days."""
    by_day = _days(ranges, "lo", "hi", day)
    return rows.join(by_day, [*KEYS, day]).where((F.col(at) >= F.col("lo")) & (F.col(at) <= F.col("hi"))).select(*rows.columns)


def recount_late(spark: SparkSession, history: DataFrame, late: str, sessions: str, corrections: str,
                 closed_before: str | None = None, gap: str = INCIDENT_GAP, sensors: Sequence[str] | DataFrame = VALID_SENSORS) -> DataFrame:
    """Correct ``sessions`` for the late rows collected since the last recount; returns the ranges counted again.

    ``history``: all readings, by ``event_date``. ``closed_before``: the watermark
    of the incidents' query (ISO text; None: the stream has ended and every
    incident is written). Days that are not over by then, and those with an
    incident that is still open, wait for a later recount.
    """
    gap_us = as_interval_micros(gap)
    kind = T.StructType([f for f in history.schema if f.name != EVENT_DATE]).add("epoch", "long")
    rows = _read(spark, f"{late}/rows", kind)
    state = _read(spark, f"{corrections}-done", f"{', '.join(f'{k} string' for k in KEYS)}, day date, waits boolean, epoch long, at long")
    last = state.agg(F.max("epoch"), F.max("at")).first()
    new = rows if last[0] is None else rows.where(F.col("epoch") > last[0])
    newest = rows.agg(F.max("epoch")).first()[0]
    touched = explode_alerts(known_sensors(new, sensors)).where(F.col(EVENT_TIME).isNotNull()).select(*KEYS, F.to_date(EVENT_TIME).alias("day"))
    touched = touched.unionByName(state.where(F.col("at") == last[1]).where("waits").select(*KEYS, "day")).distinct()
    touched = written(touched, "late-touched")
    current = read_sessions(spark, sessions, corrections)
    ranges = _ranges(touched, current, gap_us)
    alerts = explode_alerts(known_sensors(history, sensors)).select(*KEYS, EVENT_TIME, EVENT_DATE)
    if closed_before is not None:
        # open by then: a range that reaches the watermark, by its day or by an incident in it
        ranges = ranges.where(F.col("hi") < F.lit(closed_before).cast("timestamp_ntz"))
    ranges = written(ranges, "late-ranges")
    counted = incident_sessions(_inside(alerts, ranges, EVENT_DATE, EVENT_TIME).drop(EVENT_DATE), gap)
    old = _inside(current.withColumn("_d", F.to_date("start_time")), ranges, "_d", "start_time").drop("_d")
    change = counted.withColumn("weight", F.lit(1)).unionByName(old.withColumn("weight", F.lit(-1)))
    change = change.groupBy(*SESSION).agg(F.sum("weight").cast("int").alias("weight")).where("weight <> 0")
    at = time.time_ns()
    change = written(change, "late-changes")
    waits = touched.join(_days(ranges, "lo", "hi", "day").select(*KEYS, "day").distinct().withColumn("_done", F.lit(True)), [*KEYS, "day"], "left")
    done = waits.select(*KEYS, "day", F.col("_done").isNull().alias("waits"), F.lit(newest).cast("long").alias("epoch"), F.lit(at).alias("at"))
    change.write.mode("append").parquet(corrections)
    # last: a recount that stops before it is done again, and finds nothing left to correct
    done.unionByName(spark.createDataFrame([(None, None, None, False, newest, at)], done.schema)).write.mode("append").parquet(f"{corrections}-done")
    return ranges
