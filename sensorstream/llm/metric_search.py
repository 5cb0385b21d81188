"""Exact top-k by inner product with M-trees: paged metric nodes, best pages first.

Inner product becomes a distance by one more coordinate: with M the largest
norm of a tree, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the nearest are the highest scores.

Rows are dealt by hash into blocks of bounded size; each block's M-tree is
built in one task and written as a table of nodes: routing object, covering
radius, distance to the parent's routing object, and for leaf pages the
entries with their distances to the page's routing object. Queries meet every
block's tree, in chunks of bounded size. In a task, all queries of a chunk go
down the tree together, subtrees nearest first: a node is opened for the
queries whose bound max(0, d(q, c) - r) does not exceed their k-th distance so
far, the parent distance spares computing d(q, c), and an entry's stored
distance spares computing its score. Bounds carry a slack for rounding;
scores are integers, computed exactly. Each task returns k rows per query, and
a query's final k come from at most k rows per block.

Defined results: vectors that are null or hold null or non-finite components
take no part; shorter vectors count as filled up with zeros; scores must stay
below 2^53; ties go to the smaller vec_id, null ids last; a query's own row
(not another row with the same id) is left out; fewer candidates than k give
all; empty tables give an empty result; extra columns do not matter.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut

BLOCK_ROWS = 8192
CHUNK_QUERIES = 4096
PAGE, FANOUT = 256, 16

_NODES = "block int, node int, parent int, leaf boolean, center binary, radius double, parent_dist double, n int, rids binary, ids binary, dists binary, vectors binary, dim int, top double"
_NODE_SCHEMA = pa.schema([("block", pa.int32()), ("node", pa.int32()), ("parent", pa.int32()), ("leaf", pa.bool_()), ("center", pa.binary()), ("radius", pa.float64()), ("parent_dist", pa.float64()), ("n", pa.int32()), ("rids", pa.binary()), ("ids", pa.binary()), ("dists", pa.binary()), ("vectors", pa.binary()), ("dim", pa.int32()), ("top", pa.float64())])
_HITS = "q_rid long, q_id long, vec_id long, score long"
_NO_ID = np.iinfo(np.int64).max


def _matrix(column: pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """Vectors as rows of integers (float64, exact below 2^53), filled up with zeros."""
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    offsets = flat.offsets.to_numpy()
    size = np.diff(offsets)
    width = max(int(size.max()) if len(size) else 0, dim or 0)
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = flat.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return out


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x - c) ** 2).sum(1), 0))


def _build(table: pa.Table) -> pa.Table:
    """The nodes of one block's tree."""
    x = _matrix(table.column("vector"))
    norms = (x**2).sum(1)
    top = float(norms.max())
    full = np.concatenate([x, np.sqrt(np.maximum(top - norms, 0))[:, None]], 1)
    rids = table.column("rid").to_numpy()
    ids = table.column("id").fill_null(_NO_ID).to_numpy()
    block, nodes = table.column("block")[0].as_py(), []

    def grow(rows: np.ndarray, center: np.ndarray, parent: int, parent_dist: float) -> None:
        node, dist = len(nodes), _distances(full[rows], center)
        row = {"block": block, "node": node, "parent": parent, "leaf": len(rows) <= PAGE, "center": center.tobytes(), "radius": float(dist.max()), "parent_dist": parent_dist, "n": len(rows), "rids": b"", "ids": b"", "dists": b"", "vectors": b"", "dim": x.shape[1], "top": top}
        nodes.append(row)
        if row["leaf"]:
            order = np.argsort(dist, kind="stable")
            row |= {"rids": rids[rows[order]].tobytes(), "ids": ids[rows[order]].tobytes(), "dists": dist[order].tobytes(), "vectors": x[rows[order]].tobytes()}
            return
        # routing objects far from each other; every row goes to its nearest
        chosen, nearest, owner = [], np.full(len(rows), np.inf), np.zeros(len(rows), np.int64)
        new = int(dist.argmax())
        while len(chosen) < FANOUT:
            d = _distances(full[rows], full[rows[new]])
            closer = d < nearest
            owner[closer], nearest[closer] = len(chosen), d[closer]
            chosen.append(new)
            new = int(nearest.argmax())
            if nearest[new] == 0:
                break
        if len(chosen) == 1:  # equal vectors only
            owner = np.arange(len(rows)) // PAGE
            chosen = [int(np.flatnonzero(owner == k)[0]) for k in range(owner[-1] + 1)]
        for k, c in enumerate(chosen):
            if (mine := rows[owner == k]).size:
                at = full[rows[c]]
                grow(mine, at, node, float(np.sqrt(((at - center) ** 2).sum())))

    grow(np.arange(len(x)), full[0], -1, 0.0)
    return pa.Table.from_pylist(nodes, schema=_NODE_SCHEMA)


class _Best:
    """The k best scores so far of each query."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.score = k, np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), _NO_ID)

    def offer(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``score``: queries ``rows`` x candidates, -inf where there is none."""
        hit = (score >= self.score[rows, -1:]).any(1) & (score > -np.inf).any(1)
        if hit.any():
            rows, score = rows[hit], score[hit]
            s = np.concatenate([self.score[rows], score], 1)
            i = np.concatenate([self.id[rows], np.broadcast_to(ids, score.shape)], 1)
            order = np.lexsort((i, -s), axis=1)[:, : self.k]
            self.score[rows] = np.take_along_axis(s, order, 1)
            self.id[rows] = np.take_along_axis(i, order, 1)


def _search(k: int):
    def run(key: tuple, tree: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"q_rid": [], "q_id": [], "vec_id": [], "score": []}
        if tree.num_rows and queries.num_rows:
            nodes = {r["node"]: r for r in tree.to_pylist()}
            children: dict[int, list[int]] = {}
            for n, r in sorted(nodes.items()):
                children.setdefault(r["parent"], []).append(n)
            dim = nodes[0]["dim"]
            q = _matrix(queries.column("vector"), dim)
            q_rid, q_id = queries.column("rid").to_numpy(), queries.column("id").to_numpy()
            norms = (q**2).sum(1)
            top = nodes[0]["top"]
            slack = 1e-7 * (1 + np.sqrt(norms) + np.sqrt(top))
            best = _Best(len(q), k)
            limit = lambda rows: np.sqrt(np.maximum(norms[rows] + top - 2 * best.score[rows, -1], 0)) + slack[rows]

            def to_center(rows: np.ndarray, center: np.ndarray) -> np.ndarray:
                c = center[:-1]
                cross = q[rows, : len(c)] @ c
                return np.sqrt(np.maximum(norms[rows] + (center**2).sum() - 2 * cross, 0))

            start = np.arange(len(q))
            first = np.frombuffer(nodes[0]["center"])
            # nodes still to open: the least bound of any query first
            heap = [(0.0, 0, start, to_center(start, first))]
            while heap:
                _, n, rows, d = heapq.heappop(heap)
                node, bound = nodes[n], np.maximum(d - nodes[n]["radius"], 0)
                still = bound <= limit(rows)
                rows, d = rows[still], d[still]
                if not len(rows):
                    continue
                if node["leaf"]:
                    dists = np.frombuffer(node["dists"])
                    gap = np.abs(d[:, None] - dists) <= limit(rows)[:, None]  # entries the stored distances do not rule out
                    cols, mine = np.flatnonzero(gap.any(0)), np.flatnonzero(gap.any(1))
                    if not len(cols):
                        continue
                    rows = rows[mine]
                    x = np.frombuffer(node["vectors"]).reshape(-1, dim)[cols]
                    score = q[rows, :dim] @ x.T
                    score[q_rid[rows][:, None] == np.frombuffer(node["rids"], np.int64)[cols]] = -np.inf
                    best.offer(rows, score, np.frombuffer(node["ids"], np.int64)[cols])
                    continue
                for c in children[n]:
                    child = nodes[c]
                    near = np.abs(d - child["parent_dist"]) - child["radius"] <= limit(rows)
                    if near.any():
                        dc = to_center(rows[near], np.frombuffer(child["center"]))
                        heapq.heappush(heap, (float(np.maximum(dc - child["radius"], 0).mean()), c, rows[near], dc))
            at, col = np.nonzero(best.score > -np.inf)
            out = {"q_rid": q_rid[at], "q_id": q_id[at], "vec_id": best.id[at, col], "score": best.score[at, col].astype(np.int64)}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The node table of the M-trees of all rows (rid, id, vector array<double> of integers)."""
    n = vectors.count()
    blocks = max(1, -(-n // block_rows))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int"))
    return cut(dealt.groupBy("block").applyInArrow(_build, _NODES), "metric-nodes")


def top_k(index: DataFrame, queries: DataFrame, k: int = 20, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k highest scores (queries: rid, id, vector)."""
    chunks = max(1, -(-queries.count() // chunk_queries))
    asked = queries.withColumn("chunk", F.pmod(F.xxhash64("rid"), F.lit(chunks)).cast("int"))
    # every query chunk meets every block's tree: copies of bounded blocks and chunks, never pairs of rows
    trees = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    last = index.agg(F.max("block")).first()[0]
    sent = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last if last is not None else 0))))
    hits = trees.groupBy("block", "chunk").cogroup(sent.groupBy("block", "chunk")).applyInArrow(_search(k), _HITS)
    order = W.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(
        F.col("q_id").alias("query_id"), "rank", F.when(F.col("vec_id") != _NO_ID, F.col("vec_id")).alias("vec_id"), "score"
    )


def integer_vectors(table: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(rid, id, vector) with floor(scale * component), of the rows whose vector is whole and finite."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"), v.alias("v"))
    return rows.where(F.coalesce(finite, F.lit(False))).select(
        "rid", "id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("vector")
    )
