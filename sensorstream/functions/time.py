"""Time helpers. Event times are naive wall-clock values (``TIMESTAMP_NTZ``).

All arithmetic on them is done in exact microseconds and never through the
session time zone, so results do not depend on where the job runs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"

_UNITS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000,
}


def as_interval_micros(text: str) -> int:
    """``'60 seconds'`` -> 60000000. Accepts ``<n> <unit>[s]`` terms."""
    total = 0
    for qty, unit in re.findall(r"(-?\d+(?:\.\d+)?)\s*([a-zA-Z]+)", text):
        unit = unit.lower().rstrip("s")
        if unit not in _UNITS:
            raise ValueError(f"unknown time unit in {text!r}")
        total += int(float(qty) * _UNITS[unit])
    if total <= 0:
        raise ValueError(f"interval must be positive: {text!r}")
    return total


def _epoch() -> Column:
    return F.lit(_EPOCH).cast("timestamp_ntz")


def epoch_micros(col: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a naive timestamp (as if UTC).

    Built from calendar fields, which are zone-free for ``TIMESTAMP_NTZ``.
    (``timestamp_diff`` would cast to ``TIMESTAMP`` through the session time
    zone and be an hour off around daylight-saving changes.)
    """
    c = F.col(col) if isinstance(col, str) else col
    return (
        F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
        + F.hour(c).cast("long") * F.lit(3_600_000_000)
        + F.minute(c).cast("long") * F.lit(60_000_000)
        + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long")
    )


def from_epoch_micros(col: Column | str) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(col) if isinstance(col, str) else col, _epoch())


def to_instant(col: Column | str) -> Column:
    """Naive time -> ``TIMESTAMP`` with the same epoch micros (watermarks need it)."""
    return F.timestamp_micros(epoch_micros(col))


def from_instant(col: Column | str) -> Column:
    """Inverse of :func:`to_instant`."""
    return from_epoch_micros(F.unix_micros(F.col(col) if isinstance(col, str) else col))


def display_time(col: Column | str) -> Column:
    """``HH:mm:ss`` taken from the ISO text after ``T`` (text semantics, ANSI-safe).

    Text without ``T`` gives ``''``; null stays null.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(F.split_part(c, F.lit("T"), F.lit(2)), 1, 8)
