"""Live incidents: open sessions as stream state, changes as rows.

Per (sensor, alert type) the state holds the open incidents' starts, last alerts
and alert counts, a block of neighbouring incidents per map entry, so that a
micro-batch costs a state call per block and not per incident; an event-time
timer per key closes them once the watermark has passed their end, so nothing
waits for a closing message. Every micro-batch writes only what changed:

* ``opened``   an incident's first row;
* ``extended`` a later alert joined it;
* ``merged``   it went into the incident that starts at ``into`` (an alert out
  of order closed the gap, or came before its start);
* ``closed``   no alert can join it any more; its state is gone.

Rows of one incident are ordered by ``version``. Alerts older than the
watermark never reach the state; :mod:`late` counts them.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.time import as_interval_micros, epoch_micros, from_epoch_micros
from ..operators.alerts import explode_alerts
from ..operators.state import known_sensors
from ..rules import INCIDENT_GAP, VALID_SENSORS
from ..schema import EVENT_TIME

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ("sensor_id", "alert_type")
#: An entry of the state spans so many gaps, and so holds at most as many incidents, which lie more than a gap apart.
BLOCK_GAPS = 1024
_CHANGES = "sensor_id string, alert_type string, start_us long, last_us long, n_alerts long, status string, into_us long, version long"


class OpenIncidents:
    """Open incidents of one key: merges alerts in any order. ``rows``: start -> [last, count]."""

    def __init__(self, gap_us: int, rows: dict[int, list[int]]) -> None:
        self.gap, self.rows, self.starts = gap_us, rows, sorted(rows)
        self.touched: dict[int, str] = {}
        self.gone: dict[int, int] = {}

    def add(self, at: int, n: int = 1, until: int | None = None) -> None:
        """``n`` alerts at one time, or from ``at`` to ``until`` without a longer gap between them."""
        until = at if until is None else until
        # the incidents it may join: those that start up to a gap after its end, back to the first that ended more than a gap before
        hi = bisect.bisect_right(self.starts, until + self.gap)
        lo = hi
        while lo and self.rows[self.starts[lo - 1]][0] >= at - self.gap:
            lo -= 1
        joined = self.starts[lo:hi]
        start = min([at, *joined])
        last = max([until, *(self.rows[s][0] for s in joined)])
        count = n + sum(self.rows[s][1] for s in joined)
        known = any(s == start for s in joined)
        for s in joined:
            del self.rows[s]
            if s != start:
                if self.touched.pop(s, None) != "opened":
                    self.gone[s] = start
        self.starts[lo:hi] = [start]
        self.rows[start] = [last, count]
        self.gone.pop(start, None)
        if start not in self.touched:
            self.touched[start] = "extended" if known else "opened"

    def merged_into(self, start: int) -> int:
        """The open incident that holds a start."""
        return self.starts[bisect.bisect_right(self.starts, start) - 1]


def spans(times: np.ndarray, gap_us: int) -> Iterator[tuple[int, int, int]]:
    """(first, number, last) of the times in one batch that no gap parts, in any order."""
    at = np.sort(times)
    cuts = np.flatnonzero(np.diff(at) > gap_us) + 1
    first, end = np.append(0, cuts)[: len(at)], np.append(cuts, len(at))[: len(at)]
    return zip(at[first].tolist(), (end - first).tolist(), at[end - 1].tolist(), strict=True)


class _Processor(StatefulProcessor):
    def __init__(self, gap_us: int) -> None:
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # block -> its incidents as triples of 64-bit numbers: start, last alert, alerts
        self.blocks = handle.getMapState("blocks", "block long", "incidents binary")
        # the key's one timer: at or before the first end of an open incident
        self.timer = handle.getValueState("timer", "at_ms long")
        self.version = handle.getValueState("version", "version long")

    def _next_version(self) -> int:
        now = (self.version.get()[0] if self.version.exists() else 0) + 1
        self.version.update((now,))
        return now

    def _close_at(self, last_us: int) -> int:
        return (last_us + self.gap) // 1000 + 1  # first whole millisecond after the last alert's gap

    def _block(self, start: int) -> int:
        return start // (BLOCK_GAPS * self.gap)

    def _load(self) -> dict[int, tuple[int, int]]:
        """The key's open incidents: start -> (last, count)."""
        return {s: (last, n) for _, (raw,) in self.blocks.iterator() for s, last, n in np.frombuffer(raw, np.int64).reshape(-1, 3).tolist()}

    def _store(self, rows, changed: set[int], before) -> None:
        """Write the blocks of the ``changed`` starts anew; ``rows`` and ``before``: the open incidents now and as loaded."""
        had, held = {self._block(s) for s in before}, {self._block(s): [] for s in changed}
        for s in sorted(rows):
            if self._block(s) in held:
                held[self._block(s)].append((s, *rows[s]))
        for b, found in held.items():
            if found:
                self.blocks.updateValue((b,), (np.array(found, np.int64).tobytes(),))
            elif b in had:
                self.blocks.removeKey((b,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self._load()
        state = OpenIncidents(self.gap, {s: list(v) for s, v in before.items()})
        for frame in rows:
            for at, n, until in spans(frame["alert_us"].to_numpy(np.int64), self.gap):
                state.add(at, n, until)
        version, out = self._next_version(), []
        for s in sorted(state.gone):
            if s in before:
                out.append((*key, s, *before[s], "merged", state.merged_into(s), version))
        for s, status in sorted(state.touched.items()):
            last, n = state.rows[s]
            out.append((*key, s, last, n, "extended" if s in before else "opened", None, version))
        self._store(state.rows, {*state.gone, *state.touched}, before)
        self._watch(state.rows.values())
        yield _frame(out)

    def _watch(self, rows) -> None:
        """See that the timer rings by the first end of the open incidents ``rows`` (last, count)."""
        first = min((self._close_at(last) for last, _ in rows), default=None)
        if first is not None and not (self.timer.exists() and self.timer.get()[0] <= first):
            if self.timer.exists():
                self.handle.deleteTimer(self.timer.get()[0])
            self.handle.registerTimer(first)
            self.timer.update((first,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        passed, out, version = timerValues.getCurrentWatermarkInMs(), [], self._next_version()
        before = self._load()
        rows = dict(before)
        for s in sorted(before):
            if self._close_at(before[s][0]) <= passed:
                out.append((*key, s, *rows.pop(s), "closed", None, version))
        self._store(rows, before.keys() - rows.keys(), before)
        self._watch(rows.values())
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["sensor_id", "alert_type", "start_us", "last_us", "n_alerts", "status", "into_us", "version"])
    return frame.astype({"start_us": "int64", "last_us": "int64", "n_alerts": "int64", "into_us": "Int64", "version": "int64"})


def live_incidents(readings: DataFrame, gap: str = INCIDENT_GAP, sensors=VALID_SENSORS) -> DataFrame:
    """Changes of incidents (see the module) of a stream with a watermark on ``event_ts``.

    The session must keep state in RocksDB (``spark.sql.streaming.stateStore.providerClass``).
    """
    spark = readings.sparkSession
    if as_interval_micros(gap) < 2000:
        raise ValueError("timers are in milliseconds: the gap must be two at least")
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_STORE:
        raise ValueError(f"live incidents need spark.sql.streaming.stateStore.providerClass={STATE_STORE}")
    alerts = explode_alerts(known_sensors(readings, sensors)).where(F.col(EVENT_TIME).isNotNull())
    rows = alerts.select(*KEYS, "event_ts", epoch_micros(EVENT_TIME).alias("alert_us"))
    out = rows.groupBy(*KEYS).transformWithStateInPandas(_Processor(as_interval_micros(gap)), _CHANGES, "append", "eventTime")
    return out.select(
        *KEYS, from_epoch_micros("start_us").alias("start_time"), from_epoch_micros("last_us").alias("last_time"), "n_alerts", "status",
        F.when(F.col("into_us").isNotNull(), from_epoch_micros("into_us")).alias("into"), "version",
    )


def current_incidents(changes: DataFrame) -> DataFrame:
    """Latest row of every incident in the change table (merged ones are part of another): open and closed ones.

    Partial maxima per task, so a busy sensor's changes meet as one row per incident and task.
    """
    last = F.max_by(F.struct("last_time", "n_alerts", "status"), "version").alias("_last")
    rows = changes.groupBy(*KEYS, "start_time").agg(last).where("_last.status <> 'merged'")
    return rows.select(*KEYS, "start_time", "_last.last_time", "_last.n_alerts", "_last.status")


def open_incidents(changes: DataFrame, as_of: Column | None = None, gap: str = INCIDENT_GAP) -> DataFrame:
    """Incidents that an alert at ``as_of`` (default: the wall clock) would still join."""
    as_of = F.localtimestamp() if as_of is None else as_of
    since = F.timestamp_add("MICROSECOND", F.lit(-as_interval_micros(gap)), as_of)
    return current_incidents(changes).where(F.col("last_time") >= since)
