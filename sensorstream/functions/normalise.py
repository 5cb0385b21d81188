"""Measurement guards and the reading normaliser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Physical ranges of the environment measurements (fixed values of the
# original simulator): temperature 10..50, humidity 10..90, waterQuality 0..1.
RANGES = {"temperature": (10.0, 50.0), "humidity": (10.0, 90.0), "waterQuality": (0.0, 1.0)}


def measure(col: Column | str) -> Column:
    """A measurement as used by rules: NaN is treated as missing.

    Spark orders NaN above every number (``NaN > 40`` is true); a NaN reading
    must break no rule, so it is mapped to null before any comparison.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.nanvl(c, F.lit(None).cast("double"))


def normalise_readings(df: DataFrame, digits: int = 2) -> DataFrame:
    """Clamp each environment measurement to its range and round it.

    ``least``/``greatest`` skip nulls, so a missing value is guarded and stays
    missing; NaN stays NaN. Rounding is half-up.
    """
    cols = {}
    for name, (lo, hi) in RANGES.items():
        c = F.col(name)
        clamped = F.round(F.greatest(F.lit(lo), F.least(F.lit(hi), c)), digits)
        cols[name] = F.when(c.isNull() | F.isnan(c), c).otherwise(clamped)
    return df.withColumns(cols)
