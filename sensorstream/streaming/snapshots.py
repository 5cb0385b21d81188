"""Versioned snapshots of the latest-state log, with expiry.

Layout: ``snapshots/data/v=N`` holds a state (a row per sensor) and
``snapshots/folded/v=N`` the last epoch of each run it covers; the empty file
``snapshots/current/N`` is made last and makes version N exist. A refresh that
stops earlier leaves folders that no pointer names; the next one writes them
anew.

A reader takes the greatest pointer, its snapshot, and the epochs after those
it covers. Only epochs whose write has ended (``_SUCCESS``) are folded. Expiry
removes versions older than the ``keep`` newest, then the epochs covered by the
oldest version kept: a reader that started on a kept version finds all it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.state import latest_per_sensor

_FOLDED = "run string, epoch long"


class _Files:
    """Names and removal of folders on the path's own file system."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make_empty(self, path: str) -> None:
        """A new empty file, by one atomic step; an error if it is there."""
        self._fs.create(self._path(path), False).close()

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _tie(columns: Sequence[str], tie_col: str | Sequence[str] | None):
    return tie_col if tie_col is not None else ("partition", "offset") if "offset" in columns else "event_id"


def versions(spark: SparkSession, snapshots: str) -> list[int]:
    """Numbers of the versions that exist, ascending."""
    return sorted(int(n) for n in _Files(spark, snapshots).names(f"{snapshots}/current") if n.isdigit())


def epochs(spark: SparkSession, log: str) -> dict[str, list[int]]:
    """Per run the epochs of the log whose write has ended (a folder list, no data)."""
    files, out = _Files(spark, log), {}
    for run in files.names(log):
        if run.startswith("run="):
            held = [int(e[6:]) for e in files.names(f"{log}/{run}") if e.startswith("epoch=")]
            out[run[4:]] = sorted(e for e in held if files.exists(f"{log}/{run}/epoch={e}/_SUCCESS"))
    return out


def _folded(spark: SparkSession, snapshots: str, version: int) -> dict[str, int]:
    return dict(spark.read.schema(_FOLDED).parquet(f"{snapshots}/folded/v={version}").collect())  # a row per checkpoint ever used


def _state(spark: SparkSession, log: str, snapshots: str, version: int | None, tie_col) -> tuple[DataFrame, dict[str, int]]:
    """State of a version and all later epochs, and the last epoch of each run in it."""
    done = {} if version is None else _folded(spark, snapshots, version)
    there = epochs(spark, log)
    later = [f"{log}/run={r}/epoch={e}" for r, es in there.items() for e in es if e > done.get(r, -2)]
    parts = [] if version is None else [spark.read.parquet(f"{snapshots}/data/v={version}")]
    if later or not parts:
        parts.append(spark.read.option("basePath", log).parquet(*(later or [log])).drop("run", "epoch"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p.select(*rows.columns))
    last = done | {r: max(es) for r, es in there.items() if es and max(es) > done.get(r, -2)}
    return latest_per_sensor(rows, _tie(rows.columns, tie_col)), last


def current_state(spark: SparkSession, log: str, snapshots: str, tie_col: str | Sequence[str] | None = None) -> DataFrame:
    """The state now: the newest version and the epochs after it."""
    known = versions(spark, snapshots)
    return _state(spark, log, snapshots, known[-1] if known else None, tie_col)[0]


def refresh_state(spark: SparkSession, log: str, snapshots: str, tie_col: str | Sequence[str] | None = None,
                  keep: int = 2, expire: bool = True) -> DataFrame:
    """Write a new version from the newest one and the epochs after it, and return it.

    ``keep``: versions that stay; a reader must end within ``keep`` - 1
    refreshes. ``expire=False`` removes nothing. One refresh at a time: a
    second one fails at the pointer, which is made exclusively.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    files, known = _Files(spark, snapshots), versions(spark, snapshots)
    state, last = _state(spark, log, snapshots, known[-1] if known else None, tie_col)
    new = known[-1] + 1 if known else 0
    state.write.mode("overwrite").parquet(f"{snapshots}/data/v={new}")
    spark.createDataFrame(sorted(last.items()), _FOLDED).coalesce(1).write.mode("overwrite").parquet(f"{snapshots}/folded/v={new}")
    files.make_empty(f"{snapshots}/current/{new}")
    if expire:
        _expire(spark, log, snapshots, keep)
    return spark.read.parquet(f"{snapshots}/data/v={new}")


def _expire(spark: SparkSession, log: str, snapshots: str, keep: int) -> None:
    files, known = _Files(spark, snapshots), versions(spark, snapshots)
    kept = known[-keep:]
    # folders of a version go before its pointer: what a stopped expiry leaves is still named and goes next time
    for v in known[:-keep]:
        files.remove(f"{snapshots}/data/v={v}")
        files.remove(f"{snapshots}/folded/v={v}")
        files.remove(f"{snapshots}/current/{v}")
    done, log_files = _folded(spark, snapshots, kept[0]), _Files(spark, log)
    for run, es in epochs(spark, log).items():
        for e in es:
            if 0 <= e <= done.get(run, -2):
                log_files.remove(f"{log}/run={run}/epoch={e}")
