"""Ordered work without a window over a whole key: range-sorted runs.

Rows are range-partitioned and sorted by (keys, order), so a key of any size
is spread over many partitions, and written; each written file is a *run* of
the global order. Work inside a run is a window over (run, keys). As runs are
sorted by key, only the first key of a run can go on from the run before it:
one summary row per run carries what is needed across.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

RUN, AT = "_run", "_at"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back (lineage ends at files)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sorted_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "runs", shuffled: bool = False) -> DataFrame:
    """``df`` with ``_run`` (ascending in the global order) and ``_at``, the place in the run.

    The input is written first: a range sort reads it twice (once to sample),
    and parsing twice costs more than typed rows on disk. ``shuffled``: it
    comes out of a shuffle, whose files are read twice instead. Rows equal in
    keys and order are told apart by their place in the input, so even a burst
    of equal rows spreads over partitions.
    """
    rows = (df if shuffled else written(df, f"{name}-input")).withColumn("_place", F.monotonically_increasing_id())
    by = [*keys, *order, "_place"]
    out = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_place"), name)
    file = F.col("_metadata.file_path")
    # part-<partition>-...-c<file of the partition>
    part = F.regexp_extract(file, r"part-(\d+)[^/]*$", 1).cast("long")
    piece = F.coalesce(F.expr(r"try_cast(regexp_extract(_metadata.file_path, '-c([0-9]+)[^/]*$', 1) as bigint)"), F.lit(0))
    return out.select("*", (part * 1_000_000 + piece).alias(RUN), F.col("_metadata.row_index").alias(AT))


def _neighbours(runs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per run with rows of an earlier run's last key at its start: ``_run``, ``_carried`` (that run's last ``value``)."""
    ends = runs.groupBy(RUN).agg(
        F.min_by(F.struct(*keys), AT).alias("_first_key"), F.max_by(F.struct(*keys), AT).alias("_last_key"), F.max_by(value, AT).alias("_last"),
    )
    by_run = Window.orderBy(RUN)  # a row per run
    before = F.lag(F.struct("_last_key", "_last")).over(by_run)
    ends = ends.withColumn("_before", before).where(F.col("_before._last_key") == F.col("_first_key"))
    return ends.select(F.col(RUN).alias("_r"), F.col("_before._last").alias("_carried"))


def with_previous(runs: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Runs + ``name``: ``value`` of the key's row before, null for its first."""
    inside = Window.partitionBy(RUN, *keys).orderBy(AT)
    rows = runs.withColumn(name, F.lag(value).over(inside))
    carried = _neighbours(runs, keys, value)
    rows = rows.join(carried, (F.col(RUN) == F.col("_r")) & (F.col(AT) == 0), "left")
    return rows.withColumn(name, F.coalesce(name, "_carried")).drop("_r", "_carried")


def with_owner(runs: DataFrame, keys: Sequence[str], opens: str, name: str) -> DataFrame:
    """Runs + ``name``: (run, place among its key's openings) of the latest row of the key at or before this one where ``opens`` holds."""
    inside = Window.partitionBy(RUN, *keys).orderBy(AT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = runs.withColumn("_no", F.sum(F.col(opens).cast("long")).over(inside))
    per_key = runs.groupBy(RUN, *keys).agg(F.sum(F.col(opens).cast("long")).alias("_n"), F.max(AT).alias("_end"))
    ends = per_key.groupBy(RUN).agg(F.max_by("_n", "_end").alias("_n"))  # openings of the run's last key
    # the latest earlier run whose last key has one: a run that starts without an opening goes on from it
    by_run = Window.orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    last_open = F.last(F.when(F.col("_n") > 0, F.struct(F.col(RUN).alias("run"), F.col("_n").alias("no"))), ignorenulls=True).over(by_run)
    ends = ends.select(F.col(RUN).alias("_r"), last_open.alias("_from"))
    rows = rows.join(ends, (F.col(RUN) == F.col("_r")) & (F.col("_no") == 0), "left")
    own = F.struct(F.col(RUN).alias("run"), F.col("_no").alias("no"))
    return rows.withColumn(name, F.when(F.col("_no") > 0, own).otherwise(F.col("_from"))).drop("_no", "_r", "_from")


def with_rank(runs: DataFrame, keys: Sequence[str], name: str = "_rank") -> DataFrame:
    """Runs + ``name``: 0-based place of a row among its key's."""
    per_key = runs.groupBy(RUN, *keys).agg(F.min(AT).alias("_begin"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)  # a row per run of the key
    shift = per_key.select(F.col(RUN).alias("_r"), *(F.col(k).alias(f"_k_{k}") for k in keys),
                           (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_begin")).alias("_shift"))
    same = F.col(RUN) == F.col("_r")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    return runs.join(shift, same).withColumn(name, F.col(AT) + F.col("_shift")).drop("_r", "_shift", *(f"_k_{k}" for k in keys))
