"""Actuator control state from observed readings (keyed, order-dependent).

Per environment sensor and per reading, decide which actuators run after the
reading: cooling/heating on temperature, humidifying/dehumidifying on
humidity, purifying on water quality. Rules (fixed values in ``rules.py``):

1. start: a measurement beyond an actuator's start threshold starts it unless
   it already runs; it runs for ``duration`` seconds from that reading and
   clears the other actuator of its pair;
2. step: a running actuator stops when its target is reached, keeps running
   while the reading is before its end time, else stops; of a pair only the
   running one is stepped;
3. emit the flags and the command change of each running actuator.

A missing or NaN measurement meets no threshold.

The three measurement channels are independent machines. Processing is exact
and parallel over a sensor's readings, ranked by (time, id) and cut into
segments of ``max_rows_per_segment`` readings, so a burst in one instant is cut
like anything else:

* pass 1, per segment: its transfer function, the exit state for *every*
  possible incoming state. An incoming end time only matters through which of
  the segment's first readings fall before it, so the possibilities are finite;
  one backward pass finds the exits of them all.
* pass 2, a prefix scan: the functions of ``GROUP`` neighbouring segments
  compose into one of the same kind, and so on up to one per sensor; the
  incoming states then go down the same tiers.
* pass 3, per segment: replay the readings from the known incoming state.

No group holds more than ``GROUP`` functions or one segment's readings. The
same step function drives the streaming operator (``streaming.control``).
"""

from __future__ import annotations

import bisect
import operator
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import epoch_micros
from ..rules import ACTUATOR_CHANNELS, ACTUATORS, MOTION_SENSOR, step_size
from ..schema import EVENT_TIME
from .runs import sorted_runs, with_rank, written

_OPS = {">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le}
SEGMENT_ROWS = 16_384
GROUP = 64  # neighbouring segments whose functions are composed in one task
INCOMING = -1  # symbolic end time: "the incoming state's end"


@dataclass(frozen=True)
class Channel:
    measure: str
    names: tuple[str, ...]
    starts: tuple
    stops: tuple
    durations: tuple[int, ...]  # microseconds
    commands: tuple[float, ...]

    @staticmethod
    def of(measure: str, names: tuple[str, ...]) -> "Channel":
        acts = [ACTUATORS[n] for n in names]
        return Channel(
            measure, names,
            tuple((_OPS[a["start"][0]], a["start"][1]) for a in acts),
            tuple((_OPS[a["stop"][0]], a["stop"][1]) for a in acts),
            tuple(int(a["duration"] * 1_000_000) for a in acts),
            tuple(step_size(n) for n in names),
        )


CHANNELS = tuple(Channel.of(m, names) for m, names in ACTUATOR_CHANNELS)
COMMAND_COLUMNS = {"temperature": "temperature_command", "humidity": "humidity_command", "waterQuality": "water_command"}
FLAG_COLUMNS = tuple(n for _, names in ACTUATOR_CHANNELS for n in names)

OUTPUT_SCHEMA = T.StructType(
    [T.StructField("_id", T.LongType()), T.StructField("_id2", T.LongType()), T.StructField("sensor_id", T.StringType()),
     T.StructField(EVENT_TIME, T.TimestampNTZType())]
    + [T.StructField(n, T.BooleanType()) for n in FLAG_COLUMNS]
    + [T.StructField(COMMAND_COLUMNS[c.measure], T.DoubleType()) for c in CHANNELS]
)


def step(ch: Channel, mode: int, end: int | None, x: float, t: int, before_end: bool | None = None):
    """One reading on one channel. ``mode`` 0 = idle, j+1 = actuator j runs.

    ``before_end`` answers ``t < end`` when ``end`` is symbolic (INCOMING).
    Returns the new ``(mode, end)``.
    """
    valid = x == x  # NaN (also used for null) meets no threshold
    if valid:
        for j, (op, thr) in enumerate(ch.starts):
            if op(x, thr) and mode != j + 1:
                mode, end = j + 1, t + ch.durations[j]
    if mode:
        j = mode - 1
        op, thr = ch.stops[j]
        if valid and op(x, thr):
            return 0, None
        running = before_end if end == INCOMING else t < end
        if running:
            return mode, end
        return 0, None
    return 0, None


def _next_true(mask: np.ndarray) -> list[int]:
    """Per position the next one (itself included) where ``mask`` holds, ``len(mask)`` if none."""
    n = len(mask)
    at = np.where(mask, np.arange(n), n)
    return [*np.minimum.accumulate(at[::-1])[::-1].tolist(), n]


def _transfer(ch: Channel, times, xs) -> list[tuple]:
    """Exit state of one segment for every incoming state of one channel.

    Rows: (in_mode, lo, hi, out_mode, out_end, out_pass); an active incoming
    state with end ``e`` uses the row with ``lo < e <= hi`` (None = unbounded).
    ``out_pass`` means the incoming state (and its end) is still running.

    A running actuator changes only at its stop value, at another actuator's
    start or at its end, so a state is known by (actuator, reading that started
    it). One backward pass over the readings that can start an actuator finds
    the exit of every such state from the exits after it: linear in the
    segment, whatever the values.
    """
    times, xs = np.asarray(times, np.int64), np.asarray(xs, np.float64)
    n = len(times)
    starts = [op(xs, thr) for op, thr in ch.starts]
    stops = [op(xs, thr) for op, thr in ch.stops]
    any_start = np.logical_or.reduce(starts)
    next_start = _next_true(any_start)
    # readings that end actuator j's run before its time
    next_event = [_next_true(np.logical_or.reduce([stops[j], *starts[:j], *starts[j + 1:]])) for j in range(len(starts))]
    expiry = [np.searchsorted(times, times + d, "left").tolist() for d in ch.durations]
    begins = [s.tolist() for s in starts]
    t, x = times.tolist(), xs.tolist()
    idle_exit: list = [None] * n + [(0, None)]  # idle before a starting reading (or after the last one)
    run_exit: list[dict] = [{} for _ in starts]  # actuator started at a reading and still running after it

    def after(r: int, mode: int) -> tuple:
        """Exit given the mode after reading ``r``, which has just stopped or started it."""
        return run_exit[mode - 1][r] if mode else idle_exit[next_start[r + 1]]

    for s in np.flatnonzero(any_start)[::-1].tolist():
        for j, begin in enumerate(begins):
            if begin[s]:
                end = t[s] + ch.durations[j]
                r = min(next_event[j][s + 1], max(expiry[j][s], s + 1))
                run_exit[j][s] = (j + 1, end) if r == n else after(r, step(ch, j + 1, end, x[r], t[r])[0])
        idle_exit[s] = after(s, step(ch, 0, None, x[s], t[s])[0])

    idle = idle_exit[next_start[0]]
    rows = [(0, None, None, *idle, False)]
    for m in range(1, len(ch.names) + 1):
        # shared prefix: the incoming end is still ahead for readings 0..first
        first = next_event[m - 1][0]
        shared = (m, INCOMING) if first == n else after(first, step(ch, m, INCOMING, x[first], t[first], True)[0])
        # an incoming end was set at a reading before the segment's first one,
        # so it lies before that first reading + duration
        limit = t[0] + ch.durations[m - 1]
        prev = None
        for k in range(n + 1):
            # the first k readings are before the incoming end
            lo = t[k - 1] if k > 0 else None
            hi = t[k] if k < n else None
            if lo is not None and lo >= limit:
                break
            if lo is not None and hi is not None and lo == hi:
                continue
            result = shared if k == n or k > first else after(k, step(ch, m, INCOMING, x[k], t[k], False)[0])
            out = (result[0], None if result[1] == INCOMING else result[1], result[1] == INCOMING)
            if prev is not None and prev[3:] == out:
                prev = (m, prev[1], hi, *out)
                rows[-1] = prev
            else:
                prev = (m, lo, hi, *out)
                rows.append(prev)
            if k > first:  # the rest is the shared run
                rows[-1] = (m, prev[1], None, *out)
                break
    return rows


TRANSFER_SCHEMA = T.StructType(
    [T.StructField("sensor_id", T.StringType()), T.StructField("_seg", T.LongType()),
     T.StructField("channel", T.IntegerType()), T.StructField("in_mode", T.IntegerType()),
     T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()),
     T.StructField("out_mode", T.IntegerType()), T.StructField("out_end", T.LongType()),
     T.StructField("out_pass", T.BooleanType())]
)

INSTATE_SCHEMA = T.StructType(
    [T.StructField("sensor_id", T.StringType()), T.StructField("_seg", T.LongType()),
     T.StructField("channel", T.IntegerType()), T.StructField("in_mode", T.IntegerType()),
     T.StructField("in_end", T.LongType())]
)


def _sorted(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values("_rank" if "_rank" in pdf else ["_us", "_tie", "_tie2"], kind="mergesort")


def tie_columns(tie_col: str | Sequence[str]) -> list:
    """The id columns as output (``_id``, ``_id2``) and the tie-breakers ``_tie``,
    ``_tie2`` as non-null longs (a missing id sorts first). Two columns cover
    ids unique only together, e.g. Kafka partition and offset."""
    ties = [tie_col] if isinstance(tie_col, str) else list(tie_col)
    if not 1 <= len(ties) <= 2:
        raise ValueError("tie_col: one or two id columns")
    low = F.lit(-(2 ** 63))
    tie = F.coalesce(F.col(ties[0]).cast("long"), low)
    tie2 = F.coalesce(F.col(ties[1]).cast("long"), low) if len(ties) == 2 else F.lit(0).cast("long")
    ids = [F.col(t).cast("long") for t in ties] + [F.lit(None).cast("long")]
    return [ids[0].alias("_id"), ids[1].alias("_id2"), tie.alias("_tie"), tie2.alias("_tie2")]


def named_ties(out: DataFrame, tie_col: str | Sequence[str]) -> DataFrame:
    """Output with the reading's id columns under their own names."""
    ties = [tie_col] if isinstance(tie_col, str) else list(tie_col)
    return out.select(*(F.col(c).alias(t) for c, t in zip(("_id", "_id2"), ties)), *OUTPUT_SCHEMA.fieldNames()[2:])


def _floats(s: pd.Series) -> np.ndarray:
    return s.astype("float64").to_numpy()


def _segment_transfers(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    sensor, seg = key
    pdf = _sorted(pdf)
    times = pdf["_us"].to_numpy()
    out = []
    for c, ch in enumerate(CHANNELS):
        for row in _transfer(ch, times, _floats(pdf[ch.measure])):
            out.append((sensor, int(seg), c, *row))
    return pd.DataFrame(out, columns=TRANSFER_SCHEMA.fieldNames())


_LOW, _HIGH = -(2**62), 2**62  # stand for an unbounded end time


class _Transfer:
    """One channel's transfer function: rows (in_mode, lo, hi, out_mode, out_end, out_pass)."""

    def __init__(self, rows: list[tuple]) -> None:
        self.rows = sorted((m, _LOW if lo is None else lo, _HIGH if hi is None else hi, om, oe, op) for m, lo, hi, om, oe, op in rows)
        self.of_mode: dict[int, list[tuple]] = {}
        for r in self.rows:
            self.of_mode.setdefault(r[0], []).append(r)
        self.his = {m: [r[2] for r in rows_] for m, rows_ in self.of_mode.items()}

    def at(self, mode: int, end: int | None) -> tuple[int, int | None]:
        """Exit state for one incoming state."""
        rows = self.of_mode[mode]
        row = rows[0] if mode == 0 else rows[bisect.bisect_left(self.his[mode], end)]
        return row[3], (end if row[5] else row[4]) if row[3] else None

    def then(self, after: _Transfer) -> _Transfer:
        """This function followed by ``after``."""
        out: list[tuple] = []
        for m, lo, hi, om, oe, passes in self.rows:
            if not passes:
                found = [(m, lo, hi, *after.at(om, oe), False)]
            else:  # the incoming end is still ahead: it meets the next segment
                found = [(m, max(lo, l2), min(hi, h2), om2, oe2, p2) for _, l2, h2, om2, oe2, p2 in after.of_mode[om] if max(lo, l2) < min(hi, h2)]
            for r in found:
                if out and out[-1][0] == m and out[-1][3:] == r[3:]:
                    out[-1] = (m, out[-1][1], r[2], *r[3:])
                else:
                    out.append(r)
        return _Transfer([(m, None if lo == _LOW else lo, None if hi == _HIGH else hi, *rest) for m, lo, hi, *rest in out])


def _functions(pdf: pd.DataFrame) -> dict[int, list[tuple[int, _Transfer]]]:
    """Per channel the segments' functions, in segment order."""
    whole = lambda v: None if v is None or v != v else int(v)
    rows: dict[tuple, list] = {}
    for c, seg, m, lo, hi, om, oe, op in zip(*(pdf[n].tolist() for n in ("channel", "_seg", "in_mode", "lo", "hi", "out_mode", "out_end", "out_pass"))):
        rows.setdefault((int(c), int(seg)), []).append((int(m), whole(lo), whole(hi), int(om), whole(oe), bool(op)))
    out: dict[int, list] = {}
    for c, seg in sorted(rows):
        out.setdefault(c, []).append((seg, _Transfer(rows[c, seg])))
    return out


def _composed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The function of a group of neighbouring segments."""
    sensor, group = key
    out = []
    for c, parts in _functions(pdf).items():
        whole = parts[0][1]
        for _, f in parts[1:]:
            whole = whole.then(f)
        out += [(sensor, int(group), c, m, None if lo == _LOW else lo, None if hi == _HIGH else hi, om, oe, op) for m, lo, hi, om, oe, op in whole.rows]
    return pd.DataFrame(out, columns=TRANSFER_SCHEMA.fieldNames())


def _entered(key: tuple, pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Incoming state of each segment of a group from the group's own."""
    start = _states(above)
    out = []
    if len(pdf):
        for c, parts in _functions(pdf).items():
            mode, end = start.get(c, (0, None))
            for seg, f in parts:
                out.append((key[0], seg, c, mode, end))
                mode, end = f.at(mode, end)
    return pd.DataFrame(out, columns=INSTATE_SCHEMA.fieldNames())


def _states(instate: pd.DataFrame) -> dict[int, tuple]:
    return {int(r.channel): (int(r.in_mode), None if pd.isna(r.in_end) else int(r.in_end)) for r in instate.itertuples()}


def _instates(transfers: DataFrame) -> DataFrame:
    """Incoming state of every segment: functions composed upwards, states handed downwards."""
    group = F.expr(f"_seg div {GROUP}").alias("_group")
    tiers = [written(transfers, "control-transfers")]
    while (tiers[-1].agg(F.max("_seg")).first()[0] or 0) > 0:
        groups = tiers[-1].groupBy("sensor_id", group).applyInPandas(_composed, TRANSFER_SCHEMA)
        tiers.append(written(groups, "control-transfers"))
    top = tiers[-1].select("sensor_id", "_seg", "channel").distinct()
    states = top.select("*", F.lit(0).alias("in_mode"), F.lit(None).cast("long").alias("in_end"))
    for tier in reversed(tiers[:-1]):
        above = states.withColumnRenamed("_seg", "_group")
        states = tier.groupBy("sensor_id", group).cogroup(above.groupBy("sensor_id", "_group")).applyInPandas(_entered, INSTATE_SCHEMA)
    return states


def replay_rows(pdf: pd.DataFrame, starts: list[tuple]) -> tuple[pd.DataFrame, list[tuple]]:
    """Run the rules over time-sorted readings from known start states.

    ``starts`` holds one (mode, end) per channel. Returns one output row per
    reading and the final state of each channel. Shared by the batch replay
    and the streaming state function.
    """
    times = pdf["_us"].tolist()
    n = len(pdf)
    res = {"_id": pdf["_id"].array, "_id2": pdf["_id2"].array, "sensor_id": pdf["sensor_id"].to_numpy(),
           EVENT_TIME: pdf[EVENT_TIME].to_numpy()}
    finals = []
    for c, ch in enumerate(CHANNELS):
        mode, end = starts[c]
        xs = _floats(pdf[ch.measure]).tolist()
        out = [0] * n
        for i in range(n):
            mode, end = step(ch, mode, end, xs[i], times[i])
            out[i] = mode
        finals.append((mode, end))
        modes = np.array(out, dtype=np.int8)
        for j, name in enumerate(ch.names):
            res[name] = modes == j + 1
        cmd = np.full(n, np.nan)
        for j, value in enumerate(ch.commands):
            cmd[modes == j + 1] = value
        res[COMMAND_COLUMNS[ch.measure]] = cmd
    return pd.DataFrame(res)[OUTPUT_SCHEMA.fieldNames()], finals


def _replay(readings: pd.DataFrame, instate: pd.DataFrame) -> pd.DataFrame:
    """Replay one segment from its known incoming states; one row per reading."""
    if readings.empty:
        return pd.DataFrame(columns=OUTPUT_SCHEMA.fieldNames())
    known = _states(instate)
    out, _ = replay_rows(_sorted(readings), [known.get(c, (0, None)) for c in range(len(CHANNELS))])
    return out


def control_state(readings: DataFrame, tie_col: str | Sequence[str] = "event_id",
                  max_rows_per_segment: int = SEGMENT_ROWS) -> DataFrame:
    """Actuator flags and commands after every environment reading.

    ``readings`` needs ``sensor_id``, ``event_time``, ``temperature``,
    ``humidity``, ``waterQuality`` and ``tie_col``: one integer id column,
    or two that are unique together (Kafka: ``("partition", "offset")``), to
    order equal times. The output names a reading by these columns.
    Motion-sensor rows and rows without sensor or time are not controlled.
    A segment holds exactly ``max_rows_per_segment`` readings of one sensor
    (its last one fewer), however they lie in time.
    """
    base = (
        readings.filter(F.col("sensor_id").isNotNull() & (F.col("sensor_id") != MOTION_SENSOR)
                        & F.col(EVENT_TIME).isNotNull())
        .select(*tie_columns(tie_col), "sensor_id", EVENT_TIME,
                *[F.col(ch.measure).cast("double").alias(ch.measure) for ch in CHANNELS])
        .withColumn("_us", epoch_micros(EVENT_TIME))
    )
    runs = sorted_runs(base, ["sensor_id"], ["_us", "_tie", "_tie2"], "control-readings")
    ranked = with_rank(runs, ["sensor_id"]).withColumn("_seg", F.expr(f"_rank div {max_rows_per_segment}"))
    # one shuffle of the readings, shared by pass 1 and pass 3
    base = ranked.select(*base.columns, "_rank", "_seg").repartition("sensor_id", "_seg")
    transfers = base.groupBy("sensor_id", "_seg").applyInPandas(_segment_transfers, TRANSFER_SCHEMA)
    out = (
        base.groupBy("sensor_id", "_seg")
        .cogroup(_instates(transfers).groupBy("sensor_id", "_seg"))
        .applyInPandas(_replay, OUTPUT_SCHEMA)
    )
    return named_ties(out, tie_col)
