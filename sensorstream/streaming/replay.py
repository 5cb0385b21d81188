"""Replay the ``events`` table as a stream (file source), for tests and checks."""

from __future__ import annotations

import itertools
import json
import math
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import to_instant
from ..operators.runs import written
from ..session import scratch_path
from ..sources.readers import MESSAGE_SCHEMA

# A reading far after all data: it moves the watermark past every open
# session so append-mode sessions are emitted. It has to be an alerting
# reading of a known sensor: Catalyst pushes filters that do not use the
# event-time column below the watermark, so only rows that reach the session
# operator move it. Its own session ends after the watermark and is never
# emitted.
CLOSING_MESSAGE = json.dumps({"sensor_id": "sensor_1", "timestamp": "2100-01-01T00:00:00", "temperature": 99.0})

#: Rows of a message file, about.
FILE_ROWS = 100_000


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The ``events`` parquet file as a streaming source."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    # a glob: the file source wants a directory or a pattern, not a file
    return reader.parquet(f"{sf_dir.rstrip('/')}/event[s].parquet")


class Replay(NamedTuple):
    """Message files of one folder: its path, files a micro-batch, and how many seconds a row may be older than one before it."""

    path: str
    files: int
    late_seconds: int


def message_files(messages: DataFrame, time_col: str, parts: int = 6) -> Replay:
    """Messages written in ``parts`` micro-batches of equally many files each.

    Parts follow the order of the messages' times in ``time_col`` (not written;
    those without one come first); every fifth message comes one part late, so
    each part but the first overlaps the one before it. Rows about equal in
    number a part, whatever the table's size and whatever order its ids have; a
    part takes as many files as its rows need, so writing and reading it is
    spread. A batch that begins or ends inside a part is no later than one that
    does not.
    """
    spark, at = messages.sparkSession, F.unix_micros(to_instant(time_col)) / 1e6
    found = messages.select(at.alias("at"))
    n, lo, hi = found.agg(F.count(F.lit(1)), F.min("at"), F.max("at")).first()
    cuts = found.approxQuantile("at", [k / parts for k in range(1, parts)], 0.01) or [0.0] * (parts - 1)
    part = sum((F.coalesce(at > c, F.lit(False)).cast("int") for c in cuts), F.lit(0))
    late = F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    dealt, path = scratch_path(spark, "message-parts"), scratch_path(spark, "message-files")
    rows = messages.withColumn("_part", F.least(part + late, F.lit(parts - 1))).drop(time_col)
    rows.write.mode("append").partitionBy("_part").parquet(dealt)
    files = max(1, -(-n // (parts * FILE_ROWS)))
    for k in range(parts):  # one write after the other: the file source takes files by their time
        one = spark.read.schema(rows.drop("_part").schema).parquet(f"{dealt}/_part={k}") if _has(spark, f"{dealt}/_part={k}") else rows.drop("_part").limit(0)
        (one.coalesce(1) if files == 1 else one.repartition(files)).write.mode("append").parquet(path)
    ends = [lo or 0, *cuts, hi or 0]
    return Replay(path, files, math.ceil(max(b - a for a, b in itertools.pairwise(ends))) + 1)


def _has(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def time_files(rows: DataFrame, time_col: str, parts: int = 6) -> tuple[str, T.StructType]:
    """Rows written as ``parts`` files, each a range of time after the one before; the folder and its schema."""
    spark, kind = rows.sparkSession, rows.schema
    path, rows = scratch_path(spark, "time-files"), written(rows, "timed")
    ends = rows.select(F.unix_date(F.to_date(time_col)).alias("d"), F.hour(time_col).alias("h")).select((F.col("d") * 24 + F.col("h")).alias("hour"))
    cuts = ends.approxQuantile("hour", [k / parts for k in range(1, parts)], 0.01) or [0]
    hour = F.unix_date(F.to_date(time_col)) * 24 + F.hour(time_col)
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        inside = F.lit(True) if lo is None else hour > lo
        inside = inside if hi is None else inside & (hour <= hi)
        rows.where(inside).coalesce(1).write.mode("append").parquet(path)
    return path, kind


def append_closing(spark: SparkSession, path: str, files: int = 1) -> None:
    """Append closing-message files for two micro-batches to a message folder (after its data).

    Read the folder with ``maxFilesPerTrigger=files``: the first closing batch moves
    the watermark past all data, the second makes the stream run one more
    batch in which every open session is emitted (an ``availableNow`` trigger
    runs no trailing empty batch by itself).
    """
    _write_closing(spark, path, 2 * files)


def _write_closing(spark: SparkSession, path: str, n: int = 2) -> None:
    """``n`` one-message files in one write job (identical, so their order is irrelevant)."""
    one_per_slice = spark.sparkContext.parallelize([(-1, CLOSING_MESSAGE)] * n, n)
    spark.createDataFrame(one_per_slice, MESSAGE_SCHEMA).write.mode("append").parquet(path)


def closing_stream(spark: SparkSession) -> DataFrame:
    """Two closing messages as a separate source, one per micro-batch.

    Union it with a source that delivers all its data in the first batch
    (e.g. one file without ``maxFilesPerTrigger``); otherwise its first
    message would make later data late. For multi-batch replays use
    :func:`append_closing` on the data folder instead.
    """
    path = scratch_path(spark, "closing")
    _write_closing(spark, path)
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)
