"""URL filter: listed rules, and association rules mined from what they judge (native expressions only).

A listed rule (verdict, host and path prefix) decides the pages it fits. The
pages it decides are the labelled URLs: Spark's FP-growth mines combinations of
their tokens (host labels, path segments, extension, query keys) together with
the verdict. Association rules that conclude a verdict are kept from a
support and a confidence on, and pruned where a rule with one token less is as
confident. The other pages are judged by the rules left, through an inverted
index: each rule is filed under its rarest token, a page's tokens look up the
rules, and those whose other tokens the page has too apply; the most confident
wins. Pages with the same tokens are judged once.

Defined results: a null URL or one without ``://`` has empty host and path and
no tokens, so the default verdict; ties between rules of equal confidence go to
the larger support, then to more tokens, then to the smaller token list; no
labelled page (or an empty table) mines nothing; repeated rows are judged
alike, each one; extra columns do not matter.
"""

from __future__ import annotations


from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, session

#: Listed rules: (verdict, host/path prefix).
LISTED = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
DEFAULT = "allow"
_MARK = "="  # verdict items begin with it, tokens never do


def _rest(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    return F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct sorted tokens: t: top domain, h: host labels, p: path segments (numbers as #), x: extension, q: query keys."""
    host, path = host_of(url), path_of(url)
    labels = F.array_remove(F.split(host, r"\."), "")
    segments = F.array_remove(F.split(F.regexp_replace(F.regexp_replace(path, r"\.[A-Za-z0-9]+$", ""), "[0-9]+", "#"), "/"), "")
    query = F.regexp_extract_all(F.regexp_extract(_rest(url), r"\?([^#]*)", 1), F.lit("(?:^|&)([^=&]+)"), F.lit(1))
    extension = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    parts = [
        F.when(F.size(labels) > 0, F.array(F.concat(F.lit("t:"), F.element_at(labels, -1)))).otherwise(F.array().cast("array<string>")),
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("p:"), x)),
        F.when(extension != "", F.array(F.concat(F.lit("x:"), extension))).otherwise(F.array().cast("array<string>")),
        F.transform(query, lambda x: F.concat(F.lit("q:"), x)),
    ]
    return F.array_sort(F.array_distinct(F.concat(*parts)))


def listed_rule(host: Column, path: Column, listed=LISTED) -> Column:
    """Struct (rule, verdict) of the longest listed rule that fits, null for none."""
    out = None
    for verdict, rule in sorted(listed, key=lambda r: -len(r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}")
        pair = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, pair) if out is None else out.when(fits, pair)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def mine(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.9, min_count: int = 1) -> DataFrame:
    """Rules from labelled token sets (tokens, verdict): tokens, verdict, confidence, support.

    A rule needs the share ``min_support`` of the labelled sets and at least ``min_count`` of them.
    """
    empty = session(labelled).createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    n = labelled.count()
    if n < max(min_count, 1):
        return empty
    least = max(min_support, (min_count - 0.5) / n)  # half a set less: no rounding asks for one more
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(_MARK), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(baskets)
    found = model.associationRules.where(
        F.col("consequent")[0].startswith(_MARK) & ~F.exists("antecedent", lambda x: x.startswith(_MARK))
    ).select(F.array_sort("antecedent").alias("tokens"), F.substr(F.col("consequent")[0], F.lit(2)).alias("verdict"), "confidence", "support")
    found = cut(found, "url-rules")
    # a rule goes if one with a token less concludes the same as surely
    less = found.select("tokens", "verdict", "confidence", F.explode("tokens").alias("t")).select(
        "tokens", "verdict", "confidence", F.array_remove("tokens", F.col("t")).alias("shorter")
    )
    known = found.select(F.col("tokens").alias("s"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    pruned = less.join(known, (F.col("shorter") == F.col("s")) & (F.col("verdict") == F.col("v")) & (F.col("c") >= F.col("confidence"))).select("tokens", "verdict").distinct()
    return found.join(pruned, ["tokens", "verdict"], "left_anti")


def match(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The most confident rule of each distinct token set (tokens): tokens, verdict, confidence, by."""
    filed = rules.select("tokens", "verdict", "confidence", "support", F.explode("tokens").alias("t"))
    # rarest token: the one in the fewest rules' supports, by the largest support of any rule with it
    common = filed.groupBy("t").agg(F.max("support").alias("often")).withColumnRenamed("t", "t2")
    index = (
        filed.join(common, F.col("t") == F.col("t2"))
        .groupBy("tokens", "verdict", "confidence", "support").agg(F.min_by("t", F.struct("often", "t")).alias("key"))
        .withColumnRenamed("tokens", "by")
    )
    looked = token_sets.select("tokens", F.explode("tokens").alias("t")).join(index, F.col("t") == F.col("key"))
    fits = looked.where(F.size(F.array_except("by", "tokens")) == 0)
    best = F.struct("confidence", "support", F.size("by").alias("m"), F.transform("by", lambda x: x).alias("by"), "verdict")
    return fits.groupBy("tokens").agg(F.max(best).alias("b")).select(F.col("tokens").alias("judged"), "b.verdict", "b.confidence", "b.by")


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", listed=LISTED, default: str = DEFAULT,
    min_support: float = 0.01, min_confidence: float = 0.9, min_count: int = 1,
) -> DataFrame:
    """page id, host, path, rule (listed, else null), verdict, and the mined rule's tokens and confidence."""
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens")
    ).withColumn("listed", listed_rule(F.col("host"), F.col("path"), listed))
    rows = cut(rows, "url-tokens")
    rules = mine(rows.where("listed is not null").select("tokens", "listed.verdict"), min_support, min_confidence, min_count)
    open_sets = rows.where("listed is null").select("tokens").distinct()
    # written, so that both sides of the join are plain shuffles and a hot token set's pages are split over tasks
    judged = cut(match(open_sets, rules), "url-judged")
    out = rows.join(judged, (F.col("tokens") == F.col("judged")) & F.col("listed").isNull(), "left")
    return out.select(
        id_col, "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "verdict", F.lit(default)).alias("verdict"), F.col("by").alias("mined_tokens"), "confidence",
    )
