"""N-gram Jaccard join: MinHash banding, verified on full n-gram sets.

Equal texts form one class first (by md5), so copies cost one row each and are
never paired. The distinct texts get MinHash signatures over the set of their
hashed word n-grams; band and row counts are the cheapest that find a pair at
the threshold with the wanted probability. Band hashes are shuffled, and each
bucket links its members to its smallest text (a star, never all pairs).
Candidate groups are the connected components of these stars: every pair that
shares a band lies inside one. Then every pair of distinct texts inside a
candidate group is verified on the full sets: small groups many to a task,
large ones as blocks x blocks, with the counts taken from sparse-to-dense
matrix products, so the pairs themselves are never rows. Blocks are bounded in
texts and in n-grams.

Result per document: the class (smallest id of its connected component of
links), its number of links to other documents (copies included) and to other
distinct texts.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a text of one to n-1 words
has one n-gram, all its words; a text without words links only to equal texts;
a null text counts as empty; repeated rows are copies of each other; rows with
a null id take part (a class's id is its smallest non-null id, null if none);
an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of, words
from .components import cells_for, components, with_least

N = 5
THRESHOLD = 0.8
RECALL = 0.9995
BLOCK_TEXTS = 2048
BLOCK_GRAMS = 1 << 21
_CHUNK = 1 << 16  # n-grams hashed at a time, so that arrays stay in the CPU's cache


def bands_and_rows(threshold: float, recall: float, most: int = 256) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach the recall within ``most`` hashes / 4, else the fewest hashes."""
    found = []
    for rows in range(1, 17):
        bands = 1
        while (1 - threshold**rows) ** bands > 1 - recall and bands * rows <= most:
            bands += 1
        if bands * rows <= most:
            found.append((bands, rows))
    cheap = [x for x in found if x[0] * x[1] <= most // 3]
    return max(cheap, key=lambda x: x[1]) if cheap else min(found, key=lambda x: x[0] * x[1])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(values: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word n-grams of texts given their word hashes: (all grams, grams per text)."""
    short = (lengths > 0) & (lengths < n)
    if short.any():  # filled up with zeros to one n-gram
        padded = np.where(short, n, lengths)
        out = np.zeros(padded.sum(), np.uint64)
        start, old = np.cumsum(padded) - padded, np.cumsum(lengths) - lengths
        out[np.repeat(start - old, lengths) + np.arange(len(values))] = values
        values, lengths = out, padded
    count = np.maximum(lengths - n + 1, 0)
    if not len(values) or not count.sum():
        return np.zeros(0, np.uint64), count
    m = len(values) - n + 1
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + values[j : m + j]
    first = np.repeat(np.cumsum(lengths) - lengths, count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return _mixed(h[first + inside]), count


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].view(np.uint64), np.diff(offsets).astype(np.int64)


def _signatures(g: np.ndarray, count: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of the texts that have n-grams (texts x bands)."""
    rng = np.random.default_rng(20_011)
    a, b = (rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
    starts = np.cumsum(count) - count
    out = np.empty((len(count), bands), np.uint64)
    i = 0
    while i < len(count):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _CHUNK)))
        part, at = g[starts[i] : starts[j - 1] + count[j - 1]], starts[i:j] - starts[i]
        for k in range(bands):
            h = np.full(j - i, k, np.uint64)
            for r in range(k * rows, (k + 1) * rows):
                h = _mixed(h * np.uint64(31) + np.minimum.reduceat(part * a[r] + b[r] ^ (part >> np.uint64(29)), at))
            out[i:j, k] = h
        i = j
    return out


def _sign(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, count = grams(*_flat(batch.column("words")), n)
            has = count > 0
            found = _signatures(g, count[has], bands, rows)
            offsets = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), batch.column("key"), pa.array(count), lists], names=["rid", "id", "key", "n_grams", "bands"])

    return run


def _linked(sets: list[np.ndarray], i: int, j: int, num: int, den: int) -> np.ndarray:
    """Boolean matrix: is Jaccard(set of the first i, set of the rest from j) >= num / den."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[code] > 1  # an n-gram of one text alone is in no intersection
    new = np.cumsum(times > 1) - 1
    code, owner = new[code[shared]], owner[shared]
    both = np.zeros((i, len(sets) - j), np.float64)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    width = max(64, (1 << 22) // max(1, len(sets)))
    for lo in range(0, int(new[-1]) + 1 if len(new) else 0, width):
        a, b = np.searchsorted(code, (lo, lo + width))
        x = np.zeros((len(sets), width), np.float32)
        x[owner[a:b], code[a:b] - lo] = 1
        both += x[:i] @ x[j:].T
    total = sizes[:i, None] + sizes[None, j:]
    return both.astype(np.int64) * (num + den) >= num * total


def _roots(keys: list, pairs: np.ndarray) -> list:
    """Smallest key of each key's component."""
    up = list(range(len(keys)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        p, q = top(int(a)), top(int(b))
        if p != q:
            up[max(p, q, key=lambda z: keys[z])] = min(p, q, key=lambda z: keys[z])
    return [keys[top(x)] for x in range(len(keys))]


_LINKS = "key string, root string, n_links long, n_text_links long"


def _verify(n: int, threshold: Fraction):
    """One cell: whole small groups, or one block against another of a large group."""
    num, den = threshold.numerator, threshold.denominator

    def links(keys: list, copies: np.ndarray, sets: list, side: np.ndarray, whole: bool) -> tuple:
        order = sorted(range(len(keys)), key=lambda x: (side[x], keys[x]))
        keys, sets, copies, side = [keys[x] for x in order], [sets[x] for x in order], copies[order], side[order]
        split = int((side == side[0]).sum())
        if not whole and split == len(keys):  # the other block got no text; this one's pairs are counted in its own cell
            return keys, keys, np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        i, j = (len(keys), 0) if whole else (split, split)
        m = _linked(sets, i, j, num, den)
        if whole:
            np.fill_diagonal(m, False)
        docs, texts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        docs[:i] += m @ copies[j:]
        texts[:i] += m.sum(1)
        if not whole:
            docs[j:] += m.T @ copies[:i]
            texts[j:] += m.sum(0)
        # a spanning forest: the first partner of every row joins the row's other partners through one of them
        at, to = np.nonzero(m)
        return keys, _roots(keys, np.stack([at, to + j], 1) if len(keys) <= 64 else _forest(m, j)), docs, texts

    def run(table: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [])
        group = np.asarray(table.column("grp").to_pylist(), object)
        words_ = table.column("words").combine_chunks()
        words_ = words_.chunk(0) if isinstance(words_, pa.ChunkedArray) else words_
        g, count = grams(*_flat(words_), n)
        ends = np.cumsum(count)
        keys, copies, side = table.column("key").to_pylist(), table.column("copies").to_numpy(), table.column("side").to_numpy()
        whole = table.column("whole").to_pylist()
        order = np.argsort(group.astype(str), kind="stable")
        cuts = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1])) if len(order) else []
        for rows in np.split(order, cuts[1:]) if len(order) else []:
            sets = [np.unique(g[ends[r] - count[r] : ends[r]]) for r in rows]
            found = links([keys[r] for r in rows], copies[rows], sets, side[rows], whole[rows[0]])
            for o, f in zip(out, found, strict=True):
                o.extend(f if isinstance(f, list) else f.tolist())
        return pa.table({"key": pa.array(out[0], pa.string()), "root": pa.array(out[1], pa.string()), "n_links": pa.array(out[2], pa.int64()), "n_text_links": pa.array(out[3], pa.int64())})

    return run


def _forest(m: np.ndarray, j: int) -> np.ndarray:
    """Edges with the same components as the whole matrix, found row by row over unreached columns."""
    left, right = np.full(m.shape[0], -1), np.full(m.shape[1], -1)  # rows and columns not reached yet
    square = j == 0 and m.shape[0] == m.shape[1]
    edges = []
    for start in range(m.shape[0]):
        if left[start] >= 0:
            continue
        left[start], todo = start, [(0, start)]
        if square:
            right[start] = start
        while todo:
            side, x = todo.pop()
            if side == 0:
                new = np.flatnonzero(m[x] & (right < 0))
                right[new] = start
                if square:
                    left[new] = start
                edges += [(x, int(y) + j) for y in new]
                todo += [(0 if square else 1, int(y)) for y in new]
            else:
                new = np.flatnonzero(m[:, x] & (left < 0))
                left[new] = start
                edges += [(int(y), x + j) for y in new]
                todo += [(0, int(y)) for y in new]
    return np.array(edges, np.int64).reshape(-1, 2)


def _hashed_words(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL,
) -> DataFrame:
    """One row per input row: rid (row number of the scan), id, class_id, n_links, n_text_links, n_copies, first.

    ``first`` is true for one row of each class. ``docs`` must be stable when
    read twice (a table scan, or a written intermediate table).
    """
    text = text_of(text_col)
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"), F.md5(text).alias("key"), text.alias("text"),
    )
    bands, per = bands_and_rows(threshold, recall)
    signed = rows.select("rid", "id", "key", _hashed_words(F.col("text")).alias("words")).mapInArrow(
        _sign(n, bands, per), "rid long, id long, key string, n_grams long, bands array<long>"
    )
    signed = cut(signed, "ngram-signed")

    least = F.struct(F.coalesce(F.col("id"), F.lit(2**63 - 1)).alias("o"), "rid", "id")  # non-null ids first
    texts = cut(
        signed.groupBy("key").agg(F.min(least).alias("rep"), F.count("*").alias("copies"), F.max("n_grams").alias("n_grams")), "ngram-texts"
    )
    buckets = signed.select("key", F.explode("bands").alias("band")).distinct()
    n_cells = cells_for(texts.count())
    stars = with_least(buckets, "band", "key", "v", n_cells).where("key <> v").select(F.col("key").alias("u"), "v")
    groups = components(stars)

    found = cut(_links(rows, texts, groups, n, threshold), "ngram-links")
    chained = components(found.where("large").select(F.col("key").alias("u"), F.col("root").alias("v")))
    per_text = found.groupBy("key").agg(F.min("root").alias("near"), F.sum("n_links").alias("n_links"), F.sum("n_text_links").alias("n_text_links"))
    placed = (
        texts.join(per_text.withColumnRenamed("key", "k2"), F.col("key") == F.col("k2"), "left")
        .join(chained, F.col("key") == F.col("node"), "left")
        .select(
            "key", "rep", "copies", F.coalesce("root", "near", "key").alias("root"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
        )
    )
    placed = cut(placed, "ngram-placed")
    done = with_least(placed, "root", "rep", "head", n_cells).select(F.col("key").alias("k"), "head", "copies", "n_links", "n_text_links")
    return signed.select("rid", "id", "key").join(done, F.col("key") == F.col("k")).select(
        "rid", "id", F.col("head.id").alias("class_id"),
        (F.col("n_links") + F.col("copies") - 1).alias("n_links"), "n_text_links", (F.col("copies") - 1).alias("n_copies"),
        (F.col("rid") == F.col("head.rid")).alias("first"),
    )


def _links(rows: DataFrame, texts: DataFrame, groups: DataFrame, n: int, threshold: float) -> DataFrame:
    """(key, root, n_links, n_text_links, large) from verifying every candidate group."""
    members = groups.join(texts, F.col("node") == F.col("key")).select(
        F.col("root").alias("grp"), "key", "copies", "n_grams", F.col("rep.rid").alias("rep_rid")
    )
    members = cut(members, "ngram-members")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("n_grams") / BLOCK_GRAMS)).cast("int")
    sizes = members.groupBy("grp").agg(blocks.alias("n_blocks"), F.count("*").alias("m"), F.sum("n_grams").alias("total"))
    sizes = cut(sizes, "ngram-groups")
    # small groups share cells of about a block's texts or n-grams
    small = sizes.where("n_blocks = 1").agg(F.sum("m"), F.sum("total")).first()
    cells = 1 + int(max((small[0] or 0) / (BLOCK_TEXTS / 4), (small[1] or 0) / (BLOCK_GRAMS / 8)))
    block = F.when(F.col("n_blocks") > 1, F.pmod(F.xxhash64("key"), F.col("n_blocks"))).otherwise(0).cast("int")
    placed = members.join(sizes.select(F.col("grp").alias("g"), "n_blocks"), F.col("grp") == F.col("g")).withColumn("side", block)
    dealt = placed.select(
        "grp", "key", "copies", "rep_rid", "side", "n_blocks",
        F.explode(F.when(F.col("n_blocks") > 1, F.sequence(F.lit(0), F.col("n_blocks") - 1)).otherwise(F.array(F.lit(0)))).alias("other"),
    ).select(
        "grp", "key", "copies", "rep_rid", "side", (F.col("n_blocks") > 1).alias("large"), (F.col("side") == F.col("other")).alias("whole"),
        F.when(F.col("n_blocks") == 1, F.concat(F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(cells)).cast("string")))
        .otherwise(F.concat_ws("/", "grp", F.least("side", "other").cast("string"), F.greatest("side", "other").cast("string"))).alias("cell"),
    )
    # the text is fetched once for each candidate text, hashed, and only then dealt to its cells
    wanted = placed.select("rep_rid")
    fetched = rows.select("rid", "text").join(wanted, F.col("rid") == F.col("rep_rid"), "left_semi").select("rid", _hashed_words(F.col("text")).alias("words"))
    ready = dealt.join(fetched, F.col("rep_rid") == F.col("rid")).select("cell", "grp", "key", "copies", "side", "whole", "words", "large")
    wide = Fraction(threshold).limit_denominator(10_000)
    out = lambda df: df.groupBy("cell").applyInArrow(_verify(n, wide), _LINKS)
    return out(ready.where("not large").drop("large")).withColumn("large", F.lit(False)).unionByName(
        out(ready.where("large").drop("large")).withColumn("large", F.lit(True))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The first document (smallest id) of each class, with its columns, whatever these are called."""
    first = classes(docs).where("first").select(F.col("rid").alias("first_rid"))
    numbered = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.monotonically_increasing_id().alias("rid"))
    return numbered.join(first, F.col("rid") == F.col("first_rid"), "left_semi").select("row.*")
