"""Control state on a stream: keyed state per sensor (``applyInPandasWithState``).

The state of one sensor is three (mode, end) pairs plus the last processed
(time, id). Rows of a micro-batch are replayed in time order. A row not newer
than the stored state is late: it cannot change what was decided, so it comes
out with null flags and commands, to be counted and joined back, never lost.
A micro-batch bounds what one task holds of a sensor (``maxFilesPerTrigger``,
``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.time import epoch_micros
from ..operators.control import CHANNELS, FLAG_COLUMNS, OUTPUT_SCHEMA, named_ties, replay_rows, tie_columns
from ..rules import MOTION_SENSOR
from ..schema import EVENT_TIME

STATE_SCHEMA = T.StructType(
    [f for c in range(len(CHANNELS)) for f in (T.StructField(f"mode{c}", T.IntegerType()),
                                               T.StructField(f"end{c}", T.LongType()))]
    + [T.StructField("last_us", T.LongType()), T.StructField("last_tie", T.LongType()),
       T.StructField("last_tie2", T.LongType())]
)


def _advance(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    pdf = pd.concat(list(chunks), ignore_index=True)
    if state.exists:
        s = state.get
        starts = [(int(s[2 * c]), None if s[2 * c + 1] is None else int(s[2 * c + 1])) for c in range(len(CHANNELS))]
        last_us, last_tie, last_tie2 = int(s[-3]), int(s[-2]), int(s[-1])
        same_us, same_tie = pdf["_us"] == last_us, pdf["_tie"] == last_tie
        newer = ((pdf["_us"] > last_us) | (same_us & (pdf["_tie"] > last_tie))
                 | (same_us & same_tie & (pdf["_tie2"] > last_tie2)))
        late = pdf[~newer]  # the state has moved past them
        pdf = pdf[newer]
        if not late.empty:
            yield late.reindex(columns=OUTPUT_SCHEMA.fieldNames()).astype({c: "object" for c in FLAG_COLUMNS})
    else:
        starts = [(0, None)] * len(CHANNELS)
    if pdf.empty:
        return
    pdf = pdf.sort_values(["_us", "_tie", "_tie2"], kind="mergesort")
    out, finals = replay_rows(pdf, starts)
    state.update(tuple(v for mode, end in finals for v in (mode, end))
                 + (int(pdf["_us"].iloc[-1]), int(pdf["_tie"].iloc[-1]), int(pdf["_tie2"].iloc[-1])))
    yield out


def control_state_stream(readings: DataFrame, tie_col: str | Sequence[str] = "event_id") -> DataFrame:
    """Streaming twin of :func:`sensorstream.operators.control_state` (append)."""
    base = (
        readings.filter(F.col("sensor_id").isNotNull() & (F.col("sensor_id") != MOTION_SENSOR)
                        & F.col(EVENT_TIME).isNotNull())
        .select(*tie_columns(tie_col), "sensor_id", EVENT_TIME,
                *[F.col(ch.measure).cast("double").alias(ch.measure) for ch in CHANNELS])
        .withColumn("_us", epoch_micros(EVENT_TIME))
    )
    out = base.groupBy("sensor_id").applyInPandasWithState(
        _advance, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )
    return named_ties(out, tie_col)
