"""Hard-negative mining with segment summaries.

A vector is cut into ``SEGMENTS`` segments; of each the mean and the deviation
(root of the summed squared differences from the mean) are stored. Within a
segment of length n, q.x = n * mean_q * mean_x + (q - mean_q).(x - mean_x), and
the last term lies within plus or minus dev_q * dev_x, so the sums over the
segments bound the score from both sides. Coarser segments' summaries follow
from the finest's, so one stored level serves all: pairs are tried on one
segment, those that pass on four, then on all, and only what passes is scored
exactly, in integers.

Rows are put in range order of label and mean into blocks of bounded size
(a label as large as a third of all rows becomes many blocks), each a few pages
of packed rows. Anchors are packed into chunks the same way and meet blocks in
(chunk, block) pairs: for positives the blocks with one of the chunk's labels,
for negatives the blocks whose box of summaries admits a score in the window of
the chunk. Pages of a block that its box rules out are skipped the same way. A
pair returns at most the wanted number of rows for each anchor (and positive).

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; shorter vectors count as filled up with zeros; scores
must stay below 2^53 / 100; ties go to the smaller id, null ids last; a row is
no candidate of its own, another row with the same id is; an anchor without
positives, or a positive without a negative in its window, gives no row; empty
tables give an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut

SEGMENTS = 16
#: Segments tried one after the other; each divides the next.
LEVELS = (1, 4, SEGMENTS)
BLOCK_ROWS, CHUNK_ROWS, PAGE_ROWS = 32768, 8192, 512
#: Alive share of a page's pairs from which one matrix product is cheaper than single products.
DENSE = 0.2
_NO_ID = np.iinfo(np.int64).max

_PAGE = pa.schema([
    ("block", pa.int64()), ("n", pa.int32()), ("dim", pa.int32()), ("kind", pa.string()), ("labels", pa.list_(pa.int64())),
    ("rid", pa.binary()), ("id", pa.binary()), ("label", pa.binary()), ("asked", pa.binary()), ("vector", pa.binary()),
    ("mean", pa.binary()), ("dev", pa.binary()), ("goal", pa.binary()),
    ("least", pa.list_(pa.float64())), ("most", pa.list_(pa.float64())), ("spread", pa.list_(pa.float64())),
    ("low", pa.int64()), ("high", pa.int64()),
])
_PAGE_SQL = "block long, n int, dim int, kind string, labels array<long>, rid binary, id binary, label binary, asked binary, vector binary, mean binary, dev binary, goal binary, least array<double>, most array<double>, spread array<double>, low long, high long"
_HITS = "q long, goal int, c long, id long, score long"


def usable(table: DataFrame, id_col: str, vector_col: str, label: Column, scale: int, asked: Column) -> DataFrame:
    """(id, label, asked, vector: floor(scale * component)) of the rows that take part."""
    rows = table.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(asked, F.lit(False)).alias("asked"), F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double")).alias("v"),
    )
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))
    return rows.select("id", "label", "asked", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("vector"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    size = np.diff(offsets)
    out = np.zeros((len(size), dim))
    out[np.arange(dim) < size[:, None]] = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return out


def summaries(x: np.ndarray, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean and deviation of each row's segments, and a segment's length (the last is filled up with zeros)."""
    length = max(1, -(-x.shape[1] // segments))
    parts = np.zeros((len(x), segments * length))
    parts[:, : x.shape[1]] = x
    parts = parts.reshape(len(x), segments, length)
    mean = parts.mean(2)
    return mean, np.sqrt(((parts - mean[:, :, None]) ** 2).sum(2)), length


def coarser(mean: np.ndarray, dev: np.ndarray, length: int, segments: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Summaries of ``segments`` larger segments from those of smaller ones."""
    ratio = mean.shape[1] // segments
    m = mean.reshape(len(mean), segments, ratio)
    whole = m.mean(2)
    spread = (dev.reshape(m.shape) ** 2).sum(2) + length * ((m - whole[:, :, None]) ** 2).sum(2)
    return whole, np.sqrt(spread), length * ratio


def _pack(dim: int, first_block: bool):
    """Pages of a partition's rows; ``first_block``: give the rows their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = 0
        for batch in batches:
            for at in range(0, batch.num_rows, PAGE_ROWS):
                part = batch.slice(at, PAGE_ROWS)
                x = _matrix(part.column("vector"), dim)
                mean, dev, _ = summaries(x)
                top = np.abs(x).max(initial=0)
                kind = "int16" if top < 2**15 else "int32" if top < 2**31 else "float64"
                block = part.column("block").to_numpy()
                if first_block:
                    rid = (block << 32) + rank + np.arange(len(x))
                    rank += len(x)
                    goal, low, high = b"", None, None
                else:
                    rid = part.column("rid").to_numpy()
                    goals = part.column("goals").to_pylist()
                    low, high = min((g[-1] for g in goals), default=None), max((g[0] for g in goals), default=None)
                    width = max(map(len, goals), default=0)
                    goal = np.array([g + [_NO_ID] * (width - len(g)) for g in goals], np.int64).tobytes()
                label = part.column("label").to_numpy()
                page = {
                    "block": int(block[0]), "n": len(x), "dim": dim, "kind": kind, "labels": np.unique(label).tolist(), "rid": rid.tobytes(),
                    "id": part.column("id").fill_null(_NO_ID).to_numpy().tobytes(), "label": label.tobytes(),
                    "asked": part.column("asked").to_numpy(zero_copy_only=False).astype(np.int8).tobytes(), "vector": x.astype(kind).tobytes(),
                    "mean": mean.tobytes(), "dev": dev.tobytes(), "goal": goal,
                    "least": mean.min(0).tolist(), "most": mean.max(0).tolist(), "spread": dev.max(0).tolist(), "low": low, "high": high,
                }
                yield pa.RecordBatch.from_pylist([page], schema=_PAGE)

    return run


class Rows:
    """Unpacked pages."""

    def __init__(self, pages: list[dict]) -> None:
        join = lambda name, kind: np.concatenate([np.frombuffer(p[name], kind) for p in pages])
        self.rid, self.id, self.label = (join(c, np.int64) for c in ("rid", "id", "label"))
        self.vector = np.concatenate([np.frombuffer(p["vector"], p["kind"]).reshape(p["n"], p["dim"]).astype(float) for p in pages])
        mean, dev = (join(c, float).reshape(len(self.rid), SEGMENTS) for c in ("mean", "dev"))
        length = max(1, -(-self.vector.shape[1] // SEGMENTS))
        self.levels = [coarser(mean, dev, length, s) for s in LEVELS]
        self.norm = np.sqrt((self.vector**2).sum(1))
        if pages[0]["goal"]:  # per anchor its positives' scores, falling; filled up with _NO_ID
            wide = [np.frombuffer(p["goal"], np.int64).reshape(p["n"], -1) for p in pages]
            self.goal = np.full((len(self.rid), max(w.shape[1] for w in wide)), _NO_ID)
            at = 0
            for w in wide:
                self.goal[at : at + len(w), : w.shape[1]] = w
                at += len(w)


class Best:
    """The k best candidates so far of each anchor (and goal): scores fall, ties by id."""

    def __init__(self, rows: int, k: int) -> None:
        self.k = k
        self.score, self.id, self.rid = np.full((rows, k), -np.inf), np.full((rows, k), _NO_ID), np.full((rows, k), -1)

    def offer(self, row: np.ndarray, score: np.ndarray, id_: np.ndarray, rid: np.ndarray) -> None:
        """Single pairs: candidate (score, id, rid) for anchor ``row``."""
        good = score >= self.score[row, -1]
        row, score, id_, rid = row[good], score[good], id_[good], rid[good]
        if not len(row):
            return
        mine = np.unique(row)
        row = np.concatenate([row, np.repeat(mine, self.k)])
        score = np.concatenate([score, self.score[mine].ravel()])
        id_, rid = np.concatenate([id_, self.id[mine].ravel()]), np.concatenate([rid, self.rid[mine].ravel()])
        order = np.lexsort((rid, id_, -score, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept, order = place < self.k, order[place < self.k]
        at, place = row[kept], place[kept]
        self.score[at, place], self.id[at, place], self.rid[at, place] = score[order], id_[order], rid[order]

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(self.score > -np.inf)


def alive_pairs(q: Rows, qs: np.ndarray, x: Rows, wanted) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor of ``qs``, row) that the bounds do not rule out, refined level by level.

    ``wanted(anchors, rows, low, high)`` tells which scores between the bounds would count."""
    slack = 1e-9 * (1 + q.norm[qs].max(initial=0) * x.norm.max(initial=0))
    a = c = None
    for (mq, dq, length), (mx, dx, _) in zip(q.levels, x.levels, strict=True):
        if a is None or len(a) > DENSE * len(qs) * len(x.rid):
            middle, reach = length * (mq[qs] @ mx.T), dq[qs] @ dx.T + slack
            keep = wanted(qs, slice(None), middle - reach, middle + reach)
            if a is not None:
                before = np.zeros(keep.shape, bool)
                before[a, c] = True
                keep &= before
            a, c = np.nonzero(keep)
        else:
            middle = length * np.einsum("ij,ij->i", mq[qs[a]], mx[c])
            reach = np.einsum("ij,ij->i", dq[qs[a]], dx[c]) + slack
            keep = wanted(qs[a], c, middle - reach, middle + reach, False)
            a, c = a[keep], c[keep]
        if not len(a):
            break
    return a, c


def exact_scores(q: Rows, qs: np.ndarray, x: Rows, a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores of the pairs (integers below 2^53, so exact)."""
    if len(a) > DENSE * len(qs) * len(x.rid):
        return (q.vector[qs] @ x.vector.T)[a, c]
    return np.einsum("ij,ij->i", q.vector[qs[a]], x.vector[c])


def search_positives(q: Rows, pages: list[Rows], k: int) -> tuple[Best, int]:
    """Each anchor's k best other rows of its label, and the number of exact scores taken."""
    best, scored = Best(len(q.rid), k), 0
    for x in pages:
        qs = np.flatnonzero(np.isin(q.label, x.label))
        if not len(qs):
            continue

        def wanted(anchors, rows, low, high, grid=True):
            mine, floor = q.label[anchors], best.score[anchors, -1]
            return (mine[:, None] == x.label) & (high >= floor[:, None]) if grid else (mine == x.label[rows]) & (high >= floor)

        a, c = alive_pairs(q, qs, x, wanted)
        other = q.rid[qs[a]] != x.rid[c]
        a, c = a[other], c[other]
        scored += len(a)
        best.offer(qs[a], exact_scores(q, qs, x, a, c), x.id[c], x.rid[c])
    return best, scored


def search_negatives(q: Rows, pages: list[Rows], k: int, share: tuple[int, int]) -> tuple[list[Best], int]:
    """For each anchor and positive the k best rows of other labels in the positive's window, and the number of exact scores."""
    part, whole = share
    real = q.goal != _NO_ID
    top = np.where(real, q.goal, -(2**62)).astype(float)
    least = np.where(real, -((-part * np.where(real, q.goal, 0)) // whole), 2**62).astype(float)
    best, scored = [Best(len(q.rid), k) for _ in range(q.goal.shape[1])], 0
    anchors_all = np.arange(len(q.rid))
    for x in pages:

        def wanted(anchors, rows, low, high, grid=True):
            at = (lambda v: v[:, None]) if grid else (lambda v: v)
            keep = np.zeros(high.shape, bool)
            for g, b in enumerate(best):
                floor = np.maximum(least[anchors, g], b.score[anchors, -1])
                keep |= (high >= at(floor)) & (low <= at(top[anchors, g])) & at(least[anchors, g] <= top[anchors, g])
            return keep & (at(q.label[anchors]) != x.label[rows])

        a, c = alive_pairs(q, anchors_all, x, wanted)
        scored += len(a)
        score = exact_scores(q, anchors_all, x, a, c)
        for g, b in enumerate(best):
            inside = (score >= least[a, g]) & (score <= top[a, g])
            b.offer(a[inside], score[inside], x.id[c[inside]], x.rid[c[inside]])
    return best, scored


def _hit_rows(found: list[tuple[int, Best]], q: Rows) -> pa.Table:
    cols = {c: [np.zeros(0, np.int64)] for c in ("q", "goal", "c", "id", "score")}
    for goal, b in found:
        at, place = b.rows()
        for c, v in (("q", q.rid[at]), ("goal", np.full(len(at), goal)), ("c", b.rid[at, place]), ("id", b.id[at, place]), ("score", b.score[at, place])):
            cols[c].append(v.astype(np.int64))
    return pa.table({c: pa.array(np.concatenate(v), pa.int32() if c == "goal" else pa.int64()) for c, v in cols.items()})


def _meet(search):
    """One chunk's anchors against one block's pages, those with the most room for good scores first."""

    def run(key: tuple, block: pa.Table, chunk: pa.Table) -> pa.Table:
        found, q = [], None
        if block.num_rows and chunk.num_rows:
            q = Rows(chunk.to_pylist())
            pages = sorted((Rows([p]) for p in block.to_pylist()), key=lambda x: -float((q.levels[0][0].mean() * x.levels[0][0]).max()))
            found = search(q, pages)
        return _hit_rows(found, q)

    return run


def _packed(rows: DataFrame, dim: int, blocks: int, order: list, first_block: bool, name: str) -> DataFrame:
    ordered = rows.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    return cut(ordered.withColumn("block", F.spark_partition_id().cast("long")).mapInArrow(_pack(dim, first_block), _PAGE_SQL), name)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for page in batch.to_pylist():
            asked = np.flatnonzero(np.frombuffer(page["asked"], np.int8))
            if len(asked):
                x = np.frombuffer(page["vector"], page["kind"]).reshape(page["n"], page["dim"])[asked].astype(float)
                take = lambda name: pa.array(np.frombuffer(page[name], np.int64)[asked])  # noqa: B023, E731
                ids = np.frombuffer(page["id"], np.int64)[asked]
                yield pa.RecordBatch.from_arrays(
                    [take("rid"), pa.array(ids, mask=ids == _NO_ID), take("label"), pa.array(np.ones(len(asked), bool)), pa.array(list(x), pa.list_(pa.float64()))],
                    names=["rid", "id", "label", "asked", "vector"],
                )


def _met(index: DataFrame, chunks: DataFrame, pairs: DataFrame, search) -> DataFrame:
    """Hits of every (block, chunk) pair."""
    left = index.join(pairs, "block")
    right = chunks.withColumnRenamed("block", "chunk").join(pairs.withColumnRenamed("block", "b"), "chunk").withColumnRenamed("b", "block")
    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(_meet(search), _HITS)


def _boxes(pages: DataFrame, key: str) -> DataFrame:
    """Per block or chunk the box of its pages' summaries (an array over the segments) and windows."""
    parts = pages.select(F.col("block").alias(key), "low", "high", F.posexplode(F.arrays_zip("least", "most", "spread")).alias("s", "z"))
    ends = parts.groupBy(key, "s").agg(
        F.min("z.least").alias("least"), F.max("z.most").alias("most"), F.max("z.spread").alias("spread"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    box = F.sort_array(F.collect_list(F.struct("s", "least", "most", "spread")))
    return ends.groupBy(key).agg(box.alias("box"), F.min("low").alias("low"), F.max("high").alias("high"))


def _admitted(index: DataFrame, chunks: DataFrame, blocks: int, share: tuple[int, int], length: int) -> DataFrame:
    """(block, chunk) pairs whose boxes admit a score in the chunk's windows; a chunk is dealt to all blocks by number."""
    asked = _boxes(chunks, "chunk").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pairs = asked.join(_boxes(index, "block").select("block", F.col("box").alias("other")), "block")

    def ends(q: Column, x: Column) -> Column:
        corners = [length * q[a] * x[b] for a in ("least", "most") for b in ("least", "most")]
        reach = q["spread"] * x["spread"]
        return F.struct((F.least(*corners) - reach).alias("low"), (F.greatest(*corners) + reach).alias("high"))

    both = F.zip_with("box", "other", ends)
    total = lambda end: F.aggregate(both, F.lit(0.0), lambda s, e: s + e[end])
    pairs = pairs.select("block", "chunk", "low", "high", total("low").alias("lower"), total("high").alias("upper"))
    slack = 1e-6 * (1 + F.abs("upper") + F.abs("lower"))
    return pairs.where((F.col("upper") + slack >= F.col("low") * share[0] / share[1]) & (F.col("lower") - slack <= F.col("high"))).select("block", "chunk")


def mine(
    rows: DataFrame, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
    block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: id, label, asked (the anchors), vector (see :func:`usable`). For each anchor its
    ``positives`` best rows of its label; for each the ``negatives`` best rows of other labels whose
    score is at least ``share`` of the positive's and not above it.
    """
    n, dim = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // block_rows), min(cores, n // 4096))
    mean = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v) / F.greatest(F.size("vector"), F.lit(1))
    index = _packed(rows.withColumn("mean", mean), dim, blocks, ["label", "mean", F.xxhash64("vector", "id")], True, "segment-index")
    anchors = index.select("n", "dim", "kind", "rid", "id", "label", "asked", "vector").mapInArrow(_unpacked, "rid long, id long, label long, asked boolean, vector array<double>")
    anchors = cut(anchors, "anchors")
    chunks = max(1, -(-anchors.count() // chunk_rows))
    order = ["label", mean, "rid"]
    plain = _packed(anchors.withColumn("goals", F.array(F.lit(0).cast("long"))), dim, chunks, order, False, "anchor-chunks")
    # positives: blocks and chunks that share a label
    own = index.select("block", F.explode("labels").alias("label")).distinct()
    theirs = plain.select(F.col("block").alias("chunk"), F.explode("labels").alias("label")).distinct()
    pairs = own.join(theirs, "label").select("block", "chunk").distinct()
    hits = _met(index, plain, pairs, lambda q, pages: [(0, search_positives(q, pages, positives)[0])])
    best = W.partitionBy("q").orderBy(F.desc("score"), "id", "c")
    found = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    goals = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("found"))
    goals = cut(anchors.join(goals, F.col("rid") == F.col("q")).select(*anchors.columns, F.col("found.score").alias("goals"), F.col("found.id").alias("goal_ids")), "anchor-goals")
    # negatives: blocks whose box reaches a chunk's windows
    aimed = _packed(goals.drop("goal_ids"), dim, chunks, order, False, "aimed-chunks")
    pairs = _admitted(index, aimed, blocks, share, max(1, -(-dim // SEGMENTS)))
    hits = _met(index, aimed, pairs, lambda q, pages: list(enumerate(search_negatives(q, pages, negatives, share)[0])))
    best = W.partitionBy("q", "goal").orderBy(F.desc("score"), "id", "c")
    hits = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives).select("q", "goal", "rank", F.col("id").alias("n_id"), "score")
    named = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    out = hits.join(goals.select("rid", F.col("id").alias("anchor_id"), "goals", "goal_ids"), F.col("q") == F.col("rid"))
    out = out.withColumn("p_id", F.col("goal_ids")[F.col("goal")])
    return out.select(
        "anchor_id", named("p_id").alias("positive_id"), "rank", named("n_id").alias("negative_id"),
        F.col("goals")[F.col("goal")].alias("positive_score"), F.col("score").alias("negative_score"),
    )
