"""Mixing sources to target weights by hash-threshold histograms.

Every row has a fixed hash; a source takes ``base`` whole passes of all its
rows and, of one more pass, the rows whose hash lies below the source's
threshold. Thresholds come from histograms: sizes are summed by source and hash
bucket, the bucket in which the running sum crosses the budget is refined, and
only that one, with the next bits, until it holds one hash value. Nothing is
sorted or collected; the only whole-table shuffles are partial sums. Thresholds
nest: a larger budget takes a superset.

Defined results: sources are ordered by code point with null last and weighed
5, 2, 1, repeating; a null or empty text has size 0 and takes no words; rows
equal in id and text share a hash and are taken together; an empty table gives
an empty result; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, others, text_of, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BITS, STEP = 63, 9  # hash bits, and bits by which a level refines

_S, _Z, _H = "__mix_source", "__mix_size", "__mix_hash"


def _columns(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [
        F.col(source_col).cast("string").alias(_S),
        F.size(words(text_of(text_col))).cast("long").alias(_Z),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col)), 64 - BITS).alias(_H),
    ]


def targets(sources: DataFrame) -> DataFrame:
    """Water-filled targets; ``sources``: one row per source with its size.

    The targets are min(CAP * size, level * weight) where the level spends the
    whole share: what reaching a cap frees is reshared by weight until no
    target is above its cap. One row per source, so the windows are short.
    """
    order = W.orderBy(F.col(_S).isNull(), _S)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    s = sources.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(CAP))
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col(_S).isNull(), _S)
    before, after, all_rows = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(0, W.unboundedFollowing), W.partitionBy(F.lit(0))
    s = s.withColumn(
        "level",
        (F.sum("source_size").over(all_rows) * SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after),
    )
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(all_rows)["level"]
    return s.withColumn("level", level).select(
        _S, "source_size", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target")
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """Per source: size, target, whole passes ``base`` and hash threshold ``below`` of the last pass."""
    sources = rows.groupBy(_S).agg(F.sum(_Z).alias("source_size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    state = targets(sources).withColumn("base", passes).select(
        "*", (F.col("target") - F.col("base") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"), (F.col("target") <= F.col("base") * F.col("source_size")).alias("done"),
    )
    state, shift = cut(state, "mix-targets"), BITS
    while shift > 0:
        shift -= STEP
        bucket = F.shiftright(F.col(_H), shift)
        # sums by bucket inside each source's boundary bucket of the level before
        inside = rows.join(
            state.where(~F.col("done")).select(F.col(_S).alias("s"), "prefix"),
            F.col(_S).eqNullSafe(F.col("s")) & (F.shiftright(F.col(_H), shift + STEP) == F.col("prefix")) if shift + STEP < BITS else F.col(_S).eqNullSafe(F.col("s")),
        )
        sums = inside.groupBy(F.col("s").alias("s"), bucket.alias("bucket")).agg(F.sum(_Z).alias("z"), F.min(_H).alias("lo"), F.max(_H).alias("hi"))
        running = sums.withColumn("upto", F.sum("z").over(W.partitionBy("s").orderBy("bucket")))
        crossing = (
            running.join(state.select(F.col(_S).alias("s2"), "budget"), F.col("s").eqNullSafe(F.col("s2")))
            .where(F.col("upto") > F.col("budget"))
            .groupBy("s").agg(F.min_by(F.struct("bucket", "z", "upto", "lo", "hi"), "bucket").alias("b"))
        )
        old = state.join(crossing, F.col(_S).eqNullSafe(F.col("s")), "left")
        rest = F.col("budget") - (F.col("b.upto") - F.col("b.z"))
        single = F.col("b.lo") == F.col("b.hi")
        take = single & (F.col("b.z") - rest <= rest)  # of the last hash value: whichever comes nearer
        at = F.when(F.col("b").isNull(), ((F.col("prefix") + 1) * F.lit(2**STEP)) if shift + STEP < BITS else F.lit(2**STEP)).otherwise(F.col("b.bucket"))
        open_ = ~F.col("done")
        state = cut(old.select(
            _S, "source_size", "target", "base",
            F.when(open_ & F.col("b").isNotNull(), rest).otherwise(F.col("budget")).alias("budget"),
            # a finished source holds its threshold itself, an open one the bucket to refine
            F.when(~open_, F.col("prefix"))
            .when(F.col("b").isNull() | (single & ~take), at * F.lit(2**shift) if shift else at)
            .when(take, F.col("b.hi") + 1)
            .otherwise(at).alias("prefix"),
            F.when(~open_, True).otherwise(F.col("b").isNull() | single).alias("done"),
        ), "mix-thresholds")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select(_S, "source_size", "target", "base", F.col("prefix").alias("below"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (default all) + a struct ``__mix``: size, source_size, target, copies, taken."""
    keep = others(docs.columns if keep is None else keep, "__mix")
    cols = _columns(docs, id_col, text_col, source_col)
    rows = cut(docs.select(*cols), "mix-sizes")
    limits = thresholds(rows).withColumnRenamed(_S, "__mix_key")
    copies = (F.col("base") + F.when(F.col(_H) < F.col("below"), 1).otherwise(0)).cast("int")
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("__mix_row"), *cols)
    return kept.join(limits, F.col(_S).eqNullSafe(F.col("__mix_key"))).select(
        "__mix_row.*",
        F.struct(F.col(_Z).alias("size"), "source_size", "target", copies.alias("copies"), (copies * F.col(_Z)).alias("taken")).alias("__mix"),
    )


def take_mix(docs: DataFrame) -> DataFrame:
    """The mixed documents with their columns: one row per pass that takes the document."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), "doc_id", "text", "source")
    mixed = mix(packed, keep=["doc"]).where("__mix.copies > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("__mix.copies")))).select("doc.*")
