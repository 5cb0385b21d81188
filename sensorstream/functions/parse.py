"""Message parsing: bytes -> text -> typed reading (never fails, never drops)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import EVENT_TIME, READING_SCHEMA


def event_time_of(col: Column | str) -> Column:
    """ISO-8601 text -> naive timestamp; both with and without a fraction.

    Unparseable or missing text gives null rather than an error (ANSI mode).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_cast(c, "timestamp_ntz") if hasattr(F, "try_cast") else c.try_cast("timestamp_ntz")


def value_as_text(col: Column | str = "value") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def _parsed_fields(value_col: str, schema) -> Column:
    """``from_json`` expanded into columns through a one-element ``inline``.

    The generator is a barrier for predicate pushdown: a later filter on a
    parsed field stays above it instead of being rewritten into
    ``from_json(value).field`` below it, which would parse every message once
    per referenced field.
    """
    return F.inline(F.array(F.from_json(value_as_text(value_col), schema)))


def parse_readings(
    messages: DataFrame,
    value_col: str = "value",
    keep: Sequence[str] = (),
    with_event_time: bool = True,
) -> DataFrame:
    """Parse JSON messages against the fixed reading schema.

    Malformed JSON becomes a row of nulls (kept), a wrongly typed field becomes
    null on its own. ``keep`` passes source columns through (e.g. an id or the
    Kafka partition/offset used to break ties).
    """
    out = messages.select(_parsed_fields(value_col, READING_SCHEMA), *keep)
    if with_event_time:
        out = out.withColumn(EVENT_TIME, event_time_of("timestamp"))
    return out
