"""LM scoring by context-tree weighting over bytes, beside a smoothed unigram base.

The training texts' bytes are counted as n-grams (``DEPTH`` context bytes and
the next byte). A byte is eight binary decisions, so every (context, node of
the byte's binary tree) has two counts. Per node, the Krichevsky-Trofimov
probability P_e of its counts and the weighted probability
P_w = 1/2 P_e + 1/2 prod P_w(longer contexts) are computed from the longest
contexts down to none; the posterior weight P_e / 2 P_w of stopping at a
context then mixes the KT estimates of all depths on the way back up. A context
never trained hands on the estimate of the longest one that was. Texts begin
with bytes 0xFF as context and end with a byte 0xFF, which UTF-8 never holds,
so the code lengths of all texts make a distribution.

Corpus tables never reach the driver or a broadcast. Each scan partition lists
its own distinct words and n-grams with their training counts (what is
shuffled grows with the input); those lists are joined to the global figures
and sent back to their partition only, so a task's tables are bounded by its
own text. Only N, V and the number of training texts are collected.

Defined results: a null or empty text has only its end; a null id counts as
the empty text for the split; repeated rows train and are scored each; without
training texts every estimate is 1/2 per decision and the base has V = 0; an
empty table gives an empty result; extra columns do not matter. ``docs`` must
be stable when read twice (a table scan or a written table).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, text_of

DEPTH = 5
FOLDS = 10
EDGE = 0xFF
ALPHA = 0.1
_CHUNK = 1 << 20  # bytes counted at a time
_SCORED = 1 << 18  # bytes scored at a time, beside the partition's tables


def ngrams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All (context, byte) n-grams of the texts as numbers, and the number of each text (its bytes and its end)."""
    size = np.array([len(t) + 1 for t in texts], np.int64)
    edge = bytes([EDGE])
    raw = np.frombuffer(edge * depth + edge.join(texts) + edge, np.uint8).astype(np.int64)
    m = len(raw) - depth
    out = raw[depth:].copy()
    ends = np.cumsum(size)
    first = np.concatenate([[0], ends[:-1]])
    for back in range(1, depth + 1):
        before = raw[depth - back : depth - back + m].copy()
        near = first[:, None] + np.arange(back - 1)  # contexts do not reach into the text before
        near = near[near < ends[:, None]] if len(first) else near.reshape(-1)
        before[near] = EDGE
        out |= before << (8 * back)
    return out, size


def _lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, list[bytes]]]:
    """(partition, trains, some texts in lower case), about _CHUNK bytes at a time."""
    part, waiting, size = None, {True: [], False: []}, {True: 0, False: 0}
    for batch in batches:
        part = batch.column("part")[0].as_py() if batch.num_rows else part
        for text, held in zip(batch.column("text"), batch.column("held_out").to_pylist(), strict=True):
            waiting[not held].append(text.as_py().lower())
            size[not held] += len(waiting[not held][-1]) + 1
            if size[not held] > _CHUNK:
                yield part, not held, waiting[not held]
                waiting[not held], size[not held] = [], 0
    for train, texts in waiting.items():
        if texts:
            yield part, train, texts


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of a partition with their training counts."""
    words: Counter = Counter()
    seen: set = set()
    part = None
    for part, train, texts in _lowered(batches):
        for t in texts:
            (words.update if train else seen.update)(t.split())
    for w in seen:
        words.setdefault(w, 0)
    items = list(words.items())
    for at in range(0, len(items), 1 << 17):
        some = items[at : at + (1 << 17)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some), part, np.int32)), pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], names=["part", "word", "n"]
        )


def _joined(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted list of distinct numbers with their summed counts."""
    keys, counts = (np.concatenate(c) for c in zip(*lists, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _grams(depth: int):
    """Distinct n-grams of a partition with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # lists of about doubling sizes: every n-gram is merged a logarithmic number of times
        lists, part = [], None
        for part, train, texts in _lowered(batches):
            u, c = np.unique(ngrams(texts, depth)[0], return_counts=True)
            lists.append((u, c * train))
            while len(lists) > 1 and len(lists[-2][0]) < 2 * len(lists[-1][0]):
                lists[-2:] = [_joined(lists[-2:])]
        found, count = _joined(lists) if lists else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        del lists
        for at in range(0, len(found), 1 << 17):
            some = found[at : at + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), part, np.int32)), pa.array(some), pa.array(count[at : at + (1 << 17)])], names=["part", "gram", "n"])

    return run


def _lgamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1/2 (Stirling's series after seven steps up)."""
    z = x + 7
    steps = x
    for k in range(1, 7):
        steps = steps * (x + k)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def _lgamma_np(x: np.ndarray) -> np.ndarray:
    z = x + 7
    steps = x.copy()
    for k in range(1, 7):
        steps *= x + k
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(steps)


class _Levels:
    """Counts and weighted probabilities of a set of n-grams, from the longest contexts up to ``split`` bytes.

    A level's rows are (context, node) as context << 8 | node; ``up[d]`` leads
    from a row of level d to its row of level d - 1.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray, depth: int, split: int) -> None:
        byte, b = gram & 255, np.arange(8)
        self.bit = byte[:, None] >> (7 - b) & 1
        keys = (gram >> 8 << 8)[:, None] | (1 << b) + (byte[:, None] >> (8 - b))
        self.key, self.n0, self.n1, self.lpe, self.lpw, self.up = {}, {}, {}, {}, {}, {}
        self.key[depth], at = np.unique(keys, return_inverse=True)
        self.leaf = at.reshape(keys.shape)
        weight = np.broadcast_to(n[:, None], keys.shape).ravel()
        ones = self.bit.ravel()
        self.n0[depth] = np.bincount(at.ravel(), weight * (1 - ones), len(self.key[depth]))
        self.n1[depth] = np.bincount(at.ravel(), weight * ones, len(self.key[depth]))
        for d in range(depth, split - 1, -1):
            n0, n1 = self.n0[d], self.n1[d]
            self.lpe[d] = _lgamma_np(n0 + 0.5) + _lgamma_np(n1 + 0.5) - _lgamma_np(n0 + n1 + 1) - math.log(math.pi)
            self.lpw[d] = self.lpe[d] if d == depth else np.logaddexp(self.lpe[d], below) - math.log(2)
            if d > split:
                k = self.key[d]
                self.key[d - 1], self.up[d] = np.unique((k >> 8 & (1 << 8 * (d - 1)) - 1) << 8 | k & 255, return_inverse=True)
                size = len(self.key[d - 1])
                self.n0[d - 1], self.n1[d - 1], below = (np.bincount(self.up[d], v, size) for v in (n0, n1, self.lpw[d]))


_NODES = "ctx long, node int, n0 double, n1 double, lpe double, lpw double"


def _upward(depth: int, split: int):
    """The nodes of level ``split`` from a cell's n-grams."""

    def run(table: pa.Table) -> pa.Table:
        v = _Levels(table.column("gram").to_numpy(), table.column("n").to_numpy(), depth, split)
        key = v.key[split]
        return pa.table({
            "ctx": pa.array(key >> 8), "node": pa.array((key & 255).astype(np.int32)), "n0": pa.array(v.n0[split]),
            "n1": pa.array(v.n1[split]), "lpe": pa.array(v.lpe[split]), "lpw": pa.array(v.lpw[split]),
        })

    return run


def _downward(depth: int, split: int):
    """log10 probability of each n-gram's byte, given the mixture down to level ``split``."""

    def run(table: pa.Table, state: pa.Table) -> pa.Table:
        gram = table.column("gram").to_numpy()
        if not len(gram):
            return pa.table({"gram": pa.array([], pa.int64()), "lp": pa.array([], pa.float64())})
        v = _Levels(gram, table.column("n").to_numpy(), depth, split)
        key = state.column("ctx").to_numpy() << 8 | state.column("node").to_numpy()
        order = np.argsort(key)
        at = order[np.searchsorted(key[order], v.key[split])]
        w, a, p, stop = (state.column(c).to_numpy()[at] for c in ("w", "a", "p", "stop"))
        for d in range(split + 1, depth + 1):
            up, total = v.up[d], v.n0[d] + v.n1[d]
            a, w = (a + w * stop * p)[up], (w * (1 - stop))[up]
            p = np.where(total > 0, (v.n1[d] + 0.5) / (total + 1), p[up])
            stop = np.exp(v.lpe[d] - v.lpw[d] - math.log(2))
        one = (a + w * p)[v.leaf]
        return pa.table({"gram": pa.array(gram), "lp": pa.array(np.log10(np.where(v.bit == 1, one, 1 - one)).sum(1))})

    return run


def gram_scores(grams: DataFrame, depth: int) -> DataFrame:
    """log10 probability of every n-gram's byte given its context; ``grams``: gram (distinct), n (training count, may be 0).

    Contexts of up to two bytes are handled as tables; longer ones by cells of
    n-grams whose contexts end in the same two bytes, so that a cell holds
    whole subtrees. The number of cells follows the number of n-grams.
    """
    split = min(2, depth)
    cells = max(1, grams.count() >> 16)
    cell = lambda ctx: F.pmod(F.xxhash64(ctx.bitwiseAND(F.lit((1 << 8 * split) - 1))), F.lit(cells)).alias("cell")
    dealt = grams.select(cell(F.shiftright("gram", 8)), "gram", "n")
    levels = [cut(dealt.groupBy("cell").applyInArrow(_upward(depth, split), _NODES), "ctw-level")]
    kt = _lgamma(F.col("n0") + 0.5) + _lgamma(F.col("n1") + 0.5) - _lgamma(F.col("n0") + F.col("n1") + 1) - math.log(math.pi)
    for d in range(split - 1, -1, -1):
        parent = F.col("ctx").bitwiseAND(F.lit((1 << 8 * d) - 1)).alias("ctx")
        sums = levels[0].select(parent, "node", "n0", "n1", "lpw").groupBy("ctx", "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("lpw").alias("below"))
        high = F.greatest("lpe", "below")
        sums = sums.withColumn("lpe", kt).withColumn("lpw", high + F.log(F.exp(F.col("lpe") - high) + F.exp(F.col("below") - high)) - math.log(2))
        levels.insert(0, cut(sums.drop("below"), "ctw-level"))
    own = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
    stop = lambda d: F.exp(F.col("lpe") - F.col("lpw") - math.log(2)) if d < depth else F.lit(1.0)
    state = levels[0].select("ctx", "node", F.lit(1.0).alias("w"), F.lit(0.0).alias("a"), own.alias("p"), stop(0).alias("stop"))
    for d in range(1, split + 1):
        up = state.select(F.col("ctx").alias("c"), F.col("node").alias("m"), (F.col("w") * (1 - F.col("stop"))).alias("w"), (F.col("a") + F.col("w") * F.col("stop") * F.col("p")).alias("a"), F.col("p").alias("handed"))
        here = levels[d].join(up, (F.col("ctx").bitwiseAND(F.lit((1 << 8 * (d - 1)) - 1)) == F.col("c")) & (F.col("node") == F.col("m")))
        p = F.when(F.col("n0") + F.col("n1") > 0, own).otherwise(F.col("handed"))
        state = here.select("ctx", "node", "w", "a", p.alias("p"), stop(d).alias("stop"))
    state = state.select(cell(F.col("ctx")), "ctx", "node", "w", "a", "p", "stop")
    return dealt.groupBy("cell").cogroup(state.groupBy("cell")).applyInArrow(_downward(depth, split), "gram long, lp double")


_SUMS = "id long, held_out boolean, n_tokens long, n_known long, logs double, score double, words_n long, words_v long"


def _score(depth: int, ends: int):
    """Sums over each text's words and n-grams; and one row with null score for what the partition adds to N and V."""

    def run(key: tuple, docs: pa.Table, tables: pa.Table) -> pa.Table:
        is_word = pc.is_valid(tables.column("word"))
        words = tables.filter(is_word)
        code = dict(zip(words.column("word").to_pylist(), range(words.num_rows), strict=True))
        c, own = words.column("number").to_numpy(), words.column("lp").to_numpy()
        logs, known = np.log10(c + ALPHA), (c > 0).astype(np.int64)
        new = int(((c > 0) & (own >= 0)).sum())
        own = int(np.where(own < 0, -own - 1, own).sum())
        grams = tables.select(["number", "lp"]).filter(pc.invert(is_word))
        del tables, words, is_word  # the group's tables are no longer needed beside what is made of them
        gram, lp = grams.column("number").to_numpy(), grams.column("lp").to_numpy()
        del grams
        order = np.argsort(gram)
        gram = gram[order]
        lp = lp[order]
        del order
        pa.default_memory_pool().release_unused()
        n_tokens, n_known, base, score = [], [], [], []
        at, texts = 0, docs.column("text")
        while at < len(texts):
            part, size = [], 0
            while at < len(texts) and (not part or size < _SCORED):
                part.append(texts[at].as_py().lower())
                size += len(part[-1])
                at += 1
            for t in part:
                w = np.fromiter(map(code.__getitem__, t.split()), np.int64)
                n_tokens.append(len(w) + 1)
                n_known.append(int(known[w].sum()) + (ends > 0))
                base.append(float(logs[w].sum() + math.log10(ends + ALPHA)))
            g, sizes = ngrams(part, depth)
            by = np.argsort(g)  # looked up in order: neighbours lie in the same cache lines
            each = np.empty(len(g))
            each[by] = lp[np.searchsorted(gram, g[by])]
            score.extend(np.add.reduceat(each, np.cumsum(sizes) - sizes).tolist())
        nulls, m = [None], len(n_tokens)
        return pa.table({
            "id": pa.array(docs.column("id").to_pylist() + nulls, pa.int64()), "held_out": pa.array(docs.column("held_out").to_pylist() + nulls, pa.bool_()),
            "n_tokens": pa.array(n_tokens + nulls, pa.int64()), "n_known": pa.array(n_known + nulls, pa.int64()),
            "logs": pa.array(base + nulls, pa.float64()), "score": pa.array(score + nulls, pa.float64()),
            "words_n": pa.array([None] * m + [own], pa.int64()),
            "words_v": pa.array([None] * m + [new], pa.int64()),
        })

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, folds: int = FOLDS) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities) of every text."""
    held = (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0).alias("held_out")
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long").alias("id"), held, text_of(text_col).cast("binary").alias("text"))

    # a slice of partitions shares a row per n-gram, so that no list grows with the number of partitions
    listed = rows.mapInArrow(_grams(depth), "part int, gram long, n long").groupBy("gram", F.shiftright("part", 10).alias("slice"))
    listed = cut(listed.agg(F.sum("n").alias("n"), F.collect_list("part").alias("parts")).select("gram", "n", "parts"), "ctw-listed")
    # every text ends with the edge byte, which words never hold: training texts are counted by their ends
    ends = listed.where(F.col("gram").bitwiseAND(F.lit(255)) == EDGE).agg(F.sum("n")).first()[0] or 0
    grams = cut(listed.groupBy("gram").agg(F.sum("n").alias("n")), "ctw-grams")
    scores = gram_scores(grams, depth).withColumnRenamed("gram", "g")

    word = W.partitionBy("word")
    words = rows.mapInArrow(_words, "part int, word binary, n long").select(
        "part", "word", F.sum("n").over(word).alias("n"), F.col("n").alias("own"), (F.min("part").over(word) == F.col("part")).alias("first")
    )
    # one narrow table for both: a word's row has its count as number, and as lp the partition's own
    # occurrences k, or -k - 1 where an earlier partition already counts the word as distinct
    own = F.when(F.col("first"), F.col("own")).otherwise(-F.col("own") - 1).cast("double")
    tables = words.select("part", "word", F.col("n").alias("number"), own.alias("lp")).unionByName(
        listed.join(scores, F.col("gram") == F.col("g")).select(F.explode("parts").alias("part"), F.lit(None).cast("binary").alias("word"), F.col("gram").alias("number"), "lp")
    )
    sums = cut(rows.groupBy("part").cogroup(tables.groupBy("part")).applyInArrow(_score(depth, ends), _SUMS), "ctw-scores")
    total = sums.agg(F.sum("words_n"), F.sum("words_v")).first()
    n, v = (total[0] or 0) + ends, (total[1] or 0) + (ends > 0)
    each = math.log10(n + ALPHA * (v + 1))
    return sums.where("score is not null").select(
        "id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * each).alias("base_score"), "score",
    )
