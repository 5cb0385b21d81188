"""JSON serialisation of readings (publish) and enriched readings (archive)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ENRICHED_COLUMNS, ENRICHED_SCHEMA, READING_COLUMNS


def payload(cols, keep_nulls: bool) -> Column:
    """The columns as one JSON object."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[F.col(c) for c in cols]), opts)


def archive_json(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Enriched reading -> ``value`` JSON text with all nine keys, nulls explicit.

    Runs on the executors; a ``key`` column is added when ``key_col`` is given
    (a Kafka message key, e.g. the source offset).
    """
    out = [payload(ENRICHED_COLUMNS, keep_nulls=True).alias("value")]
    if key_col:
        out.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*out)


def reading_json(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Reading -> ``value`` JSON text. Absent measurements are left out, as
    sensors send them (a motion sensor sends three keys)."""
    out = [payload(READING_COLUMNS, keep_nulls=False).alias("value")]
    if key_col:
        out.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*out)


def parse_archive(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Archive JSON back to the nine enriched columns (plus other columns kept)."""
    from .parse import _parsed_fields

    others = [c for c in df.columns if c != value_col]
    return df.select(_parsed_fields(value_col, ENRICHED_SCHEMA), *others)
