"""Connected components by alternating large-star and small-star steps.

Every step is a partial minimum and a join; the edge set shrinks to one edge
per node (node, smallest node of its component). Each round's edges are
written under the shared checkpoint folder, which cuts the lineage. A hub's
edges lie in salted cells, so no task holds all edges of one node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


#: Cells of a key: at least so many, and more as rows grow, so that a cell has about this many rows at most.
LEAST_CELLS, CELL_ROWS = 64, 1 << 16


def cells_for(n_rows: int) -> int:
    """Cells per key that hold at most about ``CELL_ROWS`` rows each, even if one key has all ``n_rows``."""
    return max(LEAST_CELLS, -(-n_rows // CELL_ROWS))


def with_least(rows: DataFrame, key: str, value: str, least: str, n_cells: int = LEAST_CELLS) -> DataFrame:
    """``rows`` with the smallest ``value`` of their ``key`` as column ``least``; rows with a null key go.

    A key's rows are dealt by their value to ``n_cells`` cells; cells meet their
    key's minimum (at most ``n_cells`` rows a key), and rows meet their cell, so
    a key with most of the rows is spread over that many tasks.
    """
    dealt = rows.withColumn("__cell", F.pmod(F.xxhash64(value), F.lit(n_cells)))
    cells = dealt.groupBy(F.col(key).alias("__key"), F.col("__cell").alias("__at")).agg(F.min(value).alias("__min"))
    whole = cells.groupBy(F.col("__key").alias("__of")).agg(F.min("__min").alias(least))
    known = cells.join(whole, F.col("__key") == F.col("__of")).select("__key", "__at", least)
    return dealt.join(known, (F.col(key) == F.col("__key")) & (F.col("__cell") == F.col("__at"))).drop("__cell", "__key", "__at")


def _star(edges: DataFrame, large: bool, n_cells: int = LEAST_CELLS) -> DataFrame:
    """One star step over edges (u, v) with v < u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    joined = with_least(both, "u", "v", "least", n_cells).withColumn("m", F.least("u", "least"))
    if large:  # larger neighbours move to the smallest one
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # smaller neighbours and the node itself do
        moved = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.unionByName(joined.where("v = m").select("u", F.col("m").alias("v")))
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node of its component.

    Self-edges and repeated edges are harmless; an empty edge table gives an
    empty result. The number of rounds grows with the logarithm of the longest
    chain.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, seen = cut(e, "edges"), None
    while True:
        sign = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == seen or not sign[0]:
            break
        seen = sign
        n_cells = cells_for(2 * sign[0])
        e = cut(_star(_star(e, True, n_cells), False, n_cells), "edges")
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
