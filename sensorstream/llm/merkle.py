"""Merkle dataset manifest with nested-interval labels.

Every node of a source's tree is labelled with its level and the interval
[lo, hi) of leaf ranks it covers. An ancestor of a leaf is a node whose
interval contains the leaf's rank; since a node of level l starts at a multiple
of 3^l, the candidates are found by the bucket rank div 3^l of their level, and
containment is checked on them. A node's siblings are the nodes one level below
its parent whose intervals make up the difference between the parent's interval
and its own.

Trees are worked on in chunks of 3^BAND neighbouring leaves, so a group never
holds more than ``CHUNK`` rows, however large a source is. A chunk's task
builds its nodes; the chunks' top nodes are the leaves of the next tier, where
a chunk is found in its tier's chunk by the same containment (chunk number div
3^BAND). Proofs come down the same way: a top node's proof in its tier is
joined to its chunk, and every leaf's proof is its own up to the top node
followed by that. The sources' subroots, ordered by source, are the leaves of
one more tree.

Ranks come from one range sort over (source, id, leaf): rows keep their place
in their sorted file, and a file's first place of a source is shifted by the
number of that source's rows in earlier files.

Defined results: one row per input row; null fields enter a leaf as ``-``, so
they differ from empty ones; null sources and null ids come first; equal rows
are leaves of their own; a source of one leaf has that leaf as subroot, and a
single subroot is the root; an empty table gives no rows; extra columns, and
columns named like the results, do not matter.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import cut, others

ARITY, BAND = 3, 7
CHUNK = ARITY**BAND

_PROOF = "array<struct<before:string,after:string>>"
_PROOF_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def leaf_hash(fields: list[Column]) -> Column:
    """Hex sha256 of the fields, each as its UTF-8 byte count, a colon and its text, or ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    named = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*named).cast("binary"), 256)


def _h(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Tree:
    """Nodes over a run of leaves: per level and bucket (start div 3^level) the node's (lo, hi, hash)."""

    def __init__(self, leaves: list[str], whole: bool) -> None:
        """``whole``: the leaves are a source's all, so levels end at one node; else there are ``BAND`` levels."""
        self.levels = [{k: (k, k + 1, h) for k, h in enumerate(leaves)}]
        while len(self.levels[-1]) > 1 if whole else len(self.levels) <= BAND:
            width, below, level = ARITY ** len(self.levels), self.levels[-1], {}
            for node in sorted(below.values()):
                level.setdefault(node[0] // width, []).append(node)
            self.levels.append({b: (kids[0][0], kids[-1][1], _h([k[2] for k in kids])) for b, kids in level.items()})

    @property
    def top(self) -> str:
        return self.levels[-1][0][2]

    def ancestor(self, rank: int, level: int) -> tuple[int, int, str]:
        """The level's node whose interval contains the rank."""
        node = self.levels[level][rank // ARITY**level]
        assert node[0] <= rank < node[1]
        return node

    def siblings(self, rank: int, level: int) -> tuple[str, str]:
        """Hashes of the nodes beside the rank's node of a level, joined, before and after it: the parent's interval less its own."""
        own, parent = self.ancestor(rank, level), self.ancestor(rank, level + 1)
        nodes, width = self.levels[level], ARITY**level
        beside = [nodes[b] for b in range(parent[0] // width, -(-parent[1] // width))]
        return "".join(h for _, hi, h in beside if hi <= own[0]), "".join(h for lo, _, h in beside if lo >= own[1])

    def proof(self, rank: int) -> list[dict[str, str]]:
        steps = [self.siblings(rank, level) for level in range(len(self.levels) - 1)]
        return [{"before": a, "after": b} for a, b in steps]


def _tree_of(table: pa.Table) -> tuple[Tree, pa.Table]:
    table = table.sort_by("rank")
    return Tree(table.column("hash").to_pylist(), table.column("n")[0].as_py() <= CHUNK), table


def _tops(table: pa.Table) -> pa.Table:
    """A chunk's top node, as a leaf of the next tier."""
    tree, table = _tree_of(table)
    n = table.column("n")[0].as_py()
    row = {"grp": table.column("grp")[0].as_py(), "rank": table.column("chunk")[0].as_py(), "n": -(-n // CHUNK), "hash": tree.top}
    return pa.Table.from_pylist([row], schema=pa.schema([("grp", pa.string()), ("rank", pa.int64()), ("n", pa.int64()), ("hash", pa.string())]))


def _with_proofs(key: tuple, table: pa.Table, above: pa.Table) -> pa.Table:
    """A chunk's leaves with their proofs, within the chunk and then the chunk's own, and what comes with that."""
    if not table.num_rows or not above.num_rows:
        return pa.table({c: [] for c in (*table.column_names, "proof", "subroot", "root")})
    tree, table = _tree_of(table)
    rest, first = above.column("proof")[0].as_py(), table.column("rank")[0].as_py()
    found = [tree.proof(r - first) + rest for r in table.column("rank").to_pylist()]
    table = table.append_column("proof", pa.array(found, _PROOF_TYPE))
    for c in ("subroot", "root"):
        table = table.append_column(c, pa.array([above.column(c)[0].as_py()] * len(found), pa.string()))
    return table


def _chunked(leaves: DataFrame) -> DataFrame:
    return leaves.withColumn("chunk", F.expr(f"rank div {CHUNK}"))


def tiers(leaves: DataFrame) -> list[DataFrame]:
    """The leaves (grp, rank, n: the group's leaves, hash) and the tiers above, the last with one node a group."""
    out = [leaves]
    while len(out) == 1 or (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        chunks = _chunked(out[-1].select("grp", "rank", "n", "hash")).groupBy("grp", "chunk")
        out.append(cut(chunks.applyInArrow(_tops, "grp string, rank long, n long, hash string"), "merkle-tier"))
    return out


def proofs(found: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest tier's rows + proof, subroot, root; ``above`` (grp, proof, subroot, root): what follows each group's top node."""
    now = found[-1].join(above, "grp")
    for tier in reversed(found[:-1]):
        upper = now.select("grp", F.col("rank").alias("chunk"), "proof", "subroot", "root")
        rows = _chunked(tier)
        kind = T.StructType([*rows.schema.fields, *(upper.schema[c] for c in ("proof", "subroot", "root"))])
        now = rows.groupBy("grp", "chunk").cogroup(upper.groupBy("grp", "chunk")).applyInArrow(_with_proofs, kind)
    return now


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with a grp column) + rank in their group and n, the group's rows; ``order`` begins with grp."""
    # copies of one row may be a third of all, so the range sort also divides them
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    ordered = cut(tied.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie"), name)
    at = ordered.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    files = at.groupBy(F.col("__file").alias("f"), F.col("grp").alias("g")).agg(F.min("__at").alias("first"), F.count("*").alias("m"))
    # a sorted file's name holds its partition's number
    part = F.regexp_extract("f", r"part-(\d+)[^/]*$", 1).cast("long")
    earlier = W.partitionBy("g").orderBy(part, "f").rowsBetween(W.unboundedPreceding, -1)
    files = files.select("f", "g", (F.coalesce(F.sum("m").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("m").over(W.partitionBy("g")).alias("n"))
    out = at.join(files, (F.col("__file") == F.col("f")) & (F.col("grp") == F.col("g")))
    return cut(out.select(*rows.columns, (F.col("__at") + F.col("shift")).alias("rank"), "n"), name)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]).cast("binary"), 256))


def proof_hash(proof: Column) -> Column:
    """Hex sha256 of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def manifest(
    docs: DataFrame, fields: list[str], group_col: str = "source", order_col: str = "doc_id", keep: list[str] | None = None,
    presented: dict[str, Column] | None = None,
) -> DataFrame:
    """``keep`` columns (default all) + ``__merkle``: leaf, subroot, root, proof, folded_root, verified (in place of a column of that name).

    ``fields``: what a leaf is made of. ``presented``: fields as a holder presents them (default: as
    they are); ``folded_root`` is what their leaf gives with the manifest's siblings, ``verified``
    whether that is the root.
    """
    keep = others(docs.columns if keep is None else keep, "__merkle")
    col = lambda c: F.col(f"`{c}`")
    shown = [(presented or {}).get(f, col(f)) for f in fields]
    # '=' before a source's name tells it from null and keeps the order
    rows = docs.select(
        F.struct(*(col(c) for c in keep)).alias("row"), F.coalesce(F.concat(F.lit("="), col(group_col).cast("string")), F.lit("")).alias("grp"),
        col(order_col).alias("o"), leaf_hash([col(f) for f in fields]).alias("hash"), leaf_hash(shown).alias("shown"),
    )
    leaves = ranked(rows, ["grp", "o", "hash"], "merkle-leaves").drop("o")
    found = tiers(leaves)
    # the subroots are the leaves of the tree over the sources
    sources = ranked(found[-1].select(F.col("grp").alias("own"), "hash", F.lit("all").alias("grp")), ["grp", "own", "hash"], "merkle-sources")
    top = tiers(sources)
    summit = top[-1].select("grp", F.array().cast(_PROOF).alias("proof"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    over = proofs(top, summit).select(F.col("own").alias("grp"), "proof", F.col("hash").alias("subroot"), "root")
    out = proofs(found, cut(over, "merkle-subroots"))
    out = out.select("row", "hash", "proof", "subroot", "root", fold(F.col("shown"), F.col("proof")).alias("folded"))
    return out.select("row.*", F.struct(
        F.col("hash").alias("leaf"), "subroot", "root", "proof", F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    ).alias("__merkle"))
