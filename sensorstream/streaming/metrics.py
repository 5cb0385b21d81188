"""Counts of whole runs: rows in, rows written, rows dropped as late.

A query's ``recentProgress`` keeps only its last micro-batches.
:class:`RunMetrics` listens to all of them and stores a row per micro-batch,
so totals stay exact however long a query runs and across restarts (a
micro-batch replayed after a failure replaces its row).

:func:`counted` adds the count to the write itself (``observe``): the rows are
not read or parsed a second time to be counted.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

WRITTEN = "written"
_SCHEMA = "query string, run string, started string, batch long, rows_in long, rows_written long, rows_dropped long"


def counted(df: DataFrame) -> DataFrame:
    """``df`` that reports how many rows it hands to its sink."""
    return df.observe(WRITTEN, F.count(F.lit(1)).alias("n_rows"))


class RunMetrics(StreamingQueryListener):
    """Collects every micro-batch of the session's queries; ``spark.streams.addListener(RunMetrics())``."""

    def __init__(self) -> None:
        self._rows: dict[tuple[str, int], tuple] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = p.observedMetrics.get(WRITTEN)
        dropped = sum(op.numRowsDroppedByWatermark or 0 for op in p.stateOperators)
        row = (str(p.id), str(p.runId), p.timestamp, p.batchId, p.numInputRows, None if observed is None else observed["n_rows"], dropped)
        with self._lock:
            # an idle trigger reports the last batch again, without rows
            known = self._rows.get((row[0], row[3]))
            if known is None or known[1] != row[1] or row[4] or row[6]:
                self._rows[row[0], row[3]] = row

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait_for(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Wait until the query's last micro-batch has been reported (listeners run behind the query)."""
        last = query.lastProgress
        until = time.monotonic() + seconds
        while last and (str(last["id"]), last["batchId"]) not in self._rows:
            if time.monotonic() > until:
                raise TimeoutError("the query's last progress was not reported")
            time.sleep(0.05)

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per micro-batch seen by this listener."""
        with self._lock:
            return spark.createDataFrame(sorted(self._rows.values(), key=lambda r: (r[0], r[3])), _SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Append the rows seen since the last save to ``path``."""
        with self._lock:
            rows, self._rows = list(self._rows.values()), {}
        if rows:
            spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run_totals(batches: DataFrame) -> DataFrame:
    """Per query (checkpoint): micro-batches, rows in, written and dropped, over all runs; the last run of a micro-batch counts."""
    last = F.max_by(F.struct("rows_in", "rows_written", "rows_dropped"), "started").alias("b")
    return batches.groupBy("query", "batch").agg(last).groupBy("query").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("b.rows_in").alias("rows_in"),
        F.sum("b.rows_written").alias("rows_written"), F.sum("b.rows_dropped").alias("rows_dropped"),
    )
