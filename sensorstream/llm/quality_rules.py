"""Quality rules: learned decision lists over text measures (native expressions only).

``judge`` measures every whole text, fails the ones a fixed base rule refuses
and lets a learned, ordered list of threshold conjunctions decide the rest.

Learning is sequential covering on labelled statistics: every measure is cut at
quantiles of the labelled rows, the labelled rows are aggregated once into a
table of (cut numbers, half, label) counts, and each step asks that table for
one histogram per measure (at most measures x cuts rows reach the driver,
whatever the input). Two thirds of the rows (by hash of the id) grow a
conjunction by FOIL gain, the rest prune it to its best prefix; a rule is kept
only where its precision on the pruning rows is high, so clean documents stay.
The list is emitted as one ``CASE WHEN`` expression.

Defined results: a null or empty text has zero measures and fails the base
rule; labels with null quality, and ids labelled both ways, are not learned
from; no usable labels (or an empty table) give an empty list, which keeps all
that the base rule passes; repeated rows are judged alike, each one; extra
columns are kept whatever their names, as they travel in one struct; only one
called ``__verdict`` is replaced by the result (``keep_good`` keeps that too).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, others, text_of, words

WINDOW = 8
SYMBOLS = "[^#*$%&|<>]+"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Struct column that holds the measures.
MEASURES = "__quality_measures"
#: What the rules may test, as expressions over the measures.
RATIOS = ("n_words", "word_len", "symbols", "dup_lines", "repeats", "distinct", "upper", "other")


def _repeated(hashes: Column) -> Column:
    """Words in windows found twice or more; ``hashes``: a hash of each window, by first word."""

    def covered(at: Column) -> Column:  # sorted first words of repeated windows
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            at, start,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )

    def positions(s: Column) -> Column:  # s: (hash, position), sorted
        same = lambda i, j: F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.array_sort(F.transform(twice, lambda i: F.get(s, i)["p"]))

    def sort(h: Column) -> Column:
        return F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

    return F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        let(sort(hashes), lambda s: let(positions(s), covered)),
    ).otherwise(F.lit(0).cast("long"))


def _windows(h: Column) -> Column:
    """A hash of each run of WINDOW words; ``h``: the words' hashes."""
    return F.when(
        F.size(h) >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size(h) - WINDOW + 1), lambda i: F.xxhash64(F.slice(h, i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))


def _letters(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def measures(text: Column) -> Column:
    """Struct of counts for one text (all long, zero for an empty text)."""

    def counts(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
        return let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
                _letters(text, SYMBOLS).alias("n_symbols"),
                let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
                let(_windows(h), _repeated).alias("n_repeat_words"),
                F.size(F.array_distinct(h)).cast("long").alias("n_distinct"),
                _letters(text, "[^A-Z]+").alias("n_upper"),
                _letters(text, r"[\p{L} \t-\r]+").alias("n_other"),
            ),
        )

    return let(words(text), counts)


def _value(name: str, m: str = MEASURES) -> Column:
    n = F.greatest(F.col(f"{m}.n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(f"{m}.word_chars"), F.lit(1)).cast("double")
    return {
        "n_words": F.col(f"{m}.n_words").cast("double"),
        "word_len": F.col(f"{m}.word_chars") / n,
        "symbols": F.col(f"{m}.n_symbols") / n,
        "dup_lines": F.col(f"{m}.n_dup_lines") / n,
        "repeats": F.col(f"{m}.n_repeat_words") / n,
        "distinct": F.col(f"{m}.n_distinct") / n,
        "upper": F.col(f"{m}.n_upper") / chars,
        "other": F.col(f"{m}.n_other") / chars,
    }[name]


def base_failed(m: str = MEASURES) -> Column:
    n, r = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


@dataclass(frozen=True)
class Literal:
    """``measure > threshold`` (or <=)."""

    measure: str
    above: bool
    threshold: float
    cut: int = 0

    def on_values(self) -> Column:
        v = _value(self.measure)
        return v > F.lit(self.threshold) if self.above else v <= F.lit(self.threshold)

    def on_cuts(self) -> Column:
        c = F.col(f"c_{self.measure}")
        return c > self.cut if self.above else c <= self.cut

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class RuleList:
    """Ordered rules; a row that fits one is rejected by the first it fits."""

    rules: tuple[tuple[Literal, ...], ...] = field(default=())

    def rejecting_rule(self) -> Column:
        """Number of the first rule that fits (from 1), null for none: an ordered conditional."""
        out = F.when(F.lit(False), F.lit(0))
        for k, rule in enumerate(self.rules, 1):
            out = out.when(reduce(Column.__and__, (x.on_values() for x in rule)), F.lit(k))
        return out

    def __str__(self) -> str:
        return "\n".join(f"{k}. reject if " + " and ".join(map(str, r)) for k, r in enumerate(self.rules, 1))


def _cells(measured: DataFrame, labels: DataFrame, id_col: str, n_cuts: int):
    """Quantile cuts of each measure, and counts by (cut numbers, half, label)."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("__label_id"))
        .agg(F.min("quality").alias("__y"), F.max("quality").alias("__y2"))
        .where("__y = __y2")
    )
    rows = (
        measured.where(~base_failed())
        .select(F.col(id_col).alias("__id"), MEASURES)
        .join(known, F.col("__id") == F.col("__label_id"))
        .select("__id", "__y", *(_value(v).alias(v) for v in RATIOS))
    )
    rows = cut(rows, "quality-labelled")
    shares = [k / n_cuts for k in range(1, n_cuts)]
    found = rows.agg(*(F.percentile_approx(v, shares, 10_000).alias(v) for v in RATIOS)).first()
    cuts = {v: sorted(set(found[v] or ())) for v in RATIOS}
    number = lambda v: reduce(lambda a, t: a + F.when(F.col(v) > t, 1).otherwise(0), cuts[v], F.lit(0))
    cells = rows.groupBy(
        *(number(v).cast("int").alias(f"c_{v}") for v in RATIOS),
        (F.pmod(F.xxhash64("__id"), F.lit(3)) > 0).alias("grow"),
    ).agg(F.sum(F.when(F.col("__y") == 0, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("__y") != 0, 1).otherwise(0)).alias("good"))
    return cuts, cut(cells, "quality-cells")


def _histograms(cells: DataFrame, within: Column) -> dict[str, dict[int, tuple[int, int]]]:
    """Per measure and cut number: bad and good rows among the growing rows inside ``within``."""
    got = (
        cells.where(F.col("grow") & within)
        .select("bad", "good", F.explode(F.array(*(F.struct(F.lit(v).alias("v"), F.col(f"c_{v}").alias("c")) for v in RATIOS))).alias("x"))
        .groupBy("x.v", "x.c").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
    )
    out: dict[str, dict[int, tuple[int, int]]] = {v: {} for v in RATIOS}
    for r in got:
        out[r["v"]][r["c"]] = (r["bad"], r["good"])
    return out


def _best_literal(hist, cuts, min_cover: int) -> Literal | None:
    total = [sum(x[k] for x in hist[RATIOS[0]].values()) for k in (0, 1)]
    if not total[0] or not total[1]:
        return None
    before, best = math.log2(total[0] / sum(total)), (1e-9, None)
    for v in RATIOS:
        low_bad = low_good = 0
        for c, threshold in enumerate(cuts[v]):
            bad, good = hist[v].get(c, (0, 0))
            low_bad, low_good = low_bad + bad, low_good + good
            for above, p, n in ((False, low_bad, low_good), (True, total[0] - low_bad, total[1] - low_good)):
                if p >= min_cover:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > best[0] * (1 + 1e-12):
                        best = (gain, Literal(v, above, float(threshold), c))
    return best[1]


def learn(
    measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", n_cuts: int = 24,
    max_rules: int = 8, max_literals: int = 4, min_cover: int = 5, min_precision: float = 0.95,
) -> RuleList:
    """Ordered rejecting rules from labelled rows (``labels``: doc_id, quality 0 or 1)."""
    cuts, cells = _cells(measured, labels, id_col, n_cuts)
    rules: list[tuple[Literal, ...]] = []
    left = F.lit(True)  # rows no rule covers yet
    while len(rules) < max_rules:
        rule: list[Literal] = []
        inside = left
        while len(rule) < max_literals and (x := _best_literal(_histograms(cells, inside), cuts, min_cover)):
            rule.append(x)
            inside = inside & x.on_cuts()
        if not rule:
            break
        prefixes = [reduce(Column.__and__, (x.on_cuts() for x in rule[:k])) for k in range(1, len(rule) + 1)]
        sums = [F.sum(F.when(p, F.col(s)).otherwise(0)).alias(f"{s}{k}") for k, p in enumerate(prefixes) for s in ("bad", "good")]
        tested = cells.where(~F.col("grow") & left).agg(*sums).first()
        pn = [(tested[f"bad{k}"] or 0, tested[f"good{k}"] or 0) for k in range(len(rule))]
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in pn]
        k = max(range(len(rule)), key=lambda i: (worth[i], -i))
        p, n = pn[k]
        if p < 2 or p / (p + n) < min_precision:
            break
        rules.append(tuple(rule[: k + 1]))
        left = left & ~prefixes[k]
    return RuleList(tuple(rules))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (default all) + measures, base_failed, rule and kept in one struct column ``__verdict``.

    The texts are measured once; what is kept and the measures are written, and
    both learning and judging read them from there.
    """
    keep = others(docs.columns if keep is None else keep, "__verdict")
    # the kept columns travel in a struct, so that no name of theirs meets one of the rules'
    kept = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row") if keep else F.lit(0).alias("row")
    measured = cut(docs.select(kept, F.col(f"`{id_col}`").alias("id"), measures(text_of(f"`{text_col}`")).alias(MEASURES)), "quality-measures")
    rules = learn(measured, labels, "id")
    failed = base_failed()
    rule = rules.rejecting_rule()
    return measured.select(
        *([F.col("row.*")] if keep else []),
        F.struct(f"{MEASURES}.*", failed.alias("base_failed"), rule.alias("rule"), (~failed & rule.isNull()).alias("kept")).alias("__verdict"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns, whatever these are called."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col("doc_id"), F.col("text"))
    return judge(packed, labels, keep=["doc"]).where("__verdict.kept").select("doc.*")
