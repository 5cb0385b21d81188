"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal text form a group, which stays whole. Packing has two levels,
so that no task holds all groups: each partition packs its own groups, sorted
by size, into blocks of a small fixed capacity, each group into the block with
the tightest remaining room (found in a balanced search tree of the rooms). The
blocks, whose number is bounded by the total size over the block capacity, are
then packed the same way into the shards, at the smallest shard capacity that
needs no more shards than asked for.

Slots number a shard's rows without a global sort: the placed rows are written
in shard order, and a row's slot is its row number in its file plus what earlier
files hold of the shard.

Defined results: sizes are UTF-8 bytes plus 1, so a null or empty text has size
1 (both share one group); a group larger than a shard's fair share has a shard
to itself as far as possible, the others share the rest evenly; ties in size
are broken by the group's hash; repeated rows each get a slot; an empty table
gives an empty result; extra columns are kept whatever their names, but for one
called ``__shard``, which the result replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, others, text_of

#: Blocks a shard is made of, about: the second level packs at most 2 x shards x this, plus one block a partition.
BLOCKS_PER_SHARD = 256


class Rooms:
    """Bins by (remaining room, number) in a treap: the tightest fit in logarithmic time."""

    def __init__(self) -> None:
        self.root = None

    @staticmethod
    def _rank(key: tuple) -> int:
        return (key[0] * 0x9E3779B97F4A7C15 + key[1] * 0xC2B2AE3D27D4EB4F) % (1 << 61)

    def _merge(self, a, b):
        if not a or not b:
            return a or b
        if a[3] > b[3]:
            a[2] = self._merge(a[2], b)
            return a
        b[1] = self._merge(a, b[1])
        return b

    def _split(self, t, key):  # keys < key, keys >= key
        if not t:
            return None, None
        if t[0] < key:
            t[2], right = self._split(t[2], key)
            return t, right
        left, t[1] = self._split(t[1], key)
        return left, t

    def add(self, room: int, number: int) -> None:
        key = (room, number)
        a, b = self._split(self.root, key)
        self.root = self._merge(self._merge(a, [key, None, None, self._rank(key)]), b)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room that is enough."""
        a, b = self._split(self.root, (size, -1))
        if not b:
            self.root = a
            return None
        t = b
        while t[1]:
            t = t[1]
        key = t[0]
        _, rest = self._split(b, (key[0], key[1] + 1))
        self.root = self._merge(a, rest)
        return key


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each item; ``sizes`` must fall. An item above the capacity gets a bin of its own. None if more than ``most`` bins."""
    rooms, bins, used = Rooms(), [], 0
    for size in sizes:
        fit = rooms.take(size)
        if fit is None:
            if used == most:
                return None
            fit = (max(capacity, size), used)
            used += 1
        bins.append(fit[1])
        rooms.add(fit[0] - size, fit[1])
    return bins


def pack(sizes: list[int], shards: int) -> list[int]:
    """Bin (below ``shards``) of each item at the least capacity for which best fit needs no more; ``sizes`` must fall."""
    if not sizes:
        return []
    low, high = max(-(-sum(sizes) // shards), 1), sum(sizes)
    found = best_fit(sizes, high, shards)
    while low < high:
        middle = (low + high) // 2
        if (now := best_fit(sizes, middle, shards)) is None:
            low = middle + 1
        else:
            found, high = now, middle
    return found


def _blocks(capacity: int):
    """Pack a partition's groups into blocks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([f for f in frames if len(f)] or [pd.DataFrame({"grp": [], "bytes": [], "part": []})])
        rows = rows.sort_values(["bytes", "grp"], ascending=[False, True])
        if len(rows):
            bins = best_fit([int(x) for x in rows["bytes"]], capacity)
            yield pd.DataFrame({"grp": rows["grp"], "bytes": rows["bytes"].astype("int64"), "block": [f"{p}-{b}" for p, b in zip(rows["part"], bins, strict=True)]})

    return run


def _place(shards: int):
    """Pack all blocks (a bounded number) into the shards."""

    def run(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values(["bytes", "block"], ascending=[False, True])
        return pd.DataFrame({"block": blocks["block"], "shard": pack([int(x) for x in blocks["bytes"]], shards)})

    return run


def shard(docs: DataFrame, shards: int = 16, text_col: str = "text", keep: list[str] | None = None, order_col: str = "doc_id") -> DataFrame:
    """``keep`` columns (default all) + a struct ``__shard``: size, text_crc32, shard, slot."""
    keep = others(docs.columns if keep is None else keep, "__shard")
    text = text_of(text_col)
    rows = cut(docs.select(
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col(order_col).alias("o"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), F.md5(text).alias("grp"),
    ), "shard-rows")
    groups = rows.groupBy("grp").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    capacity = max(1, total // (shards * BLOCKS_PER_SHARD))
    # dealt by group, so that a partition's groups are the same on every run; each task sorts only its own
    n = max(1, min(4 * BLOCKS_PER_SHARD, total // (64 << 20) + 8))
    dealt = groups.repartition(n, "grp").withColumn("part", F.spark_partition_id())
    blocks = cut(dealt.mapInPandas(_blocks(capacity), "grp string, bytes long, block string"), "shard-blocks")
    sums = blocks.groupBy("block").agg(F.sum("bytes").alias("bytes"))
    placed = sums.groupBy(F.lit(0).alias("all")).applyInPandas(_place(shards), "block string, shard int")
    where = blocks.join(placed.withColumnRenamed("block", "b"), F.col("block") == F.col("b")).select(F.col("grp").alias("g"), "shard")
    put = cut(rows.join(where, F.col("grp") == F.col("g")).select("row", "o", "size", "crc", "shard"), "shard-placed")
    return _numbered(put)


def _numbered(put: DataFrame) -> DataFrame:
    ordered = cut(put.repartitionByRange("shard", "o", F.xxhash64("row")).sortWithinPartitions("shard", "o", "crc"), "shard-ordered")
    at = ordered.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index"))
    first = at.groupBy("file", "shard").agg(F.min("index").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = first.select(F.col("file").alias("f"), F.col("shard").alias("s"), (before - F.col("first")).alias("shift"))
    return at.join(first, (F.col("file") == F.col("f")) & (F.col("shard") == F.col("s"))).select(
        "row.*", F.struct("size", F.col("crc").alias("text_crc32"), "shard", (F.col("index") + F.col("shift")).alias("slot")).alias("__shard")
    )
