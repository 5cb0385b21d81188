"""Message sources: Kafka, or files holding the same messages.

Every reader returns a DataFrame with a ``value`` column holding one JSON
message per row (binary from Kafka, string from files) plus source columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.parse import parse_readings

# Message files: one JSON text per row, optionally with an id used as offset.
MESSAGE_SCHEMA = T.StructType([T.StructField("event_id", T.LongType(), True), T.StructField("value", T.StringType(), True)])


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    stream: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Open a message source, batch or stream.

    ``fmt="kafka"`` needs the Spark Kafka package on the classpath and
    ``options`` from :func:`kafka_options`. ``parquet``/``json`` read message
    files with a declared schema (no inference); ``text`` reads one message
    per line into ``value``.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt).options(**(options or {}))
    if fmt in ("parquet", "json", "orc"):
        reader = reader.schema(schema or MESSAGE_SCHEMA)
    return reader.load(path) if path else reader.load()


def read_readings(spark: SparkSession, path: str | None = None, fmt: str = "kafka",
                  options: dict[str, str] | None = None, stream: bool = False, keep=()) -> DataFrame:
    """Source + parse in one call: typed readings with ``event_time``.

    For Kafka, ``keep`` defaults to ``partition`` and ``offset`` (unique per
    message, used to break timestamp ties).
    """
    msgs = read_messages(spark, path, fmt, options, stream)
    if not keep:
        keep = ("partition", "offset") if fmt == "kafka" else tuple(c for c in msgs.columns if c != "value")
    return parse_readings(msgs, keep=keep)


def spread_small_input(df: DataFrame, max_parts: int = 256) -> DataFrame:
    """Spread an input read as fewer splits than the session has cores.

    Parquet splits at row-group boundaries, so a small file with one row
    group is a single task. A round-robin repartition then lets the cores
    share the parsing (at most ``max_parts`` partitions: a fixed-number
    repartition is not coalesced by AQE, and a tiny input on a large cluster
    should not become thousands of empty tasks). The number of partitions only
    ever grows: an input with as many splits is returned unchanged (no shuffle).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = min(cores, max_parts)
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def history(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Raw reading history: a table/view name, or a path written by
    :func:`write_history`."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)
