"""Queries of this subpackage's operators, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, context_tree, hard_negatives, html_extract, license_scan, merkle, metric_search, mixing, ngram_join, quality_rules,
    sharding, token_files, url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rule and learned decision list over every document."""
    out = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), keep=["doc_id"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return out.select("doc_id", *(F.col(f"__verdict.{n}").alias(n) for n in names))


def op2_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together."""
    out = sharding.shard(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select(
        "doc_id", "__shard.size", "__shard.text_crc32", F.lit("bytes").alias("law"), "__shard.shard",
        F.col("__shard.slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by listed and mined rules; a mined rule rests on at least five pages."""
    return url_filter.judge(_table(spark, sf_dir, "pages"), min_count=5)


def op4_metric_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest scores of every query vector (vec_id divisible by 20) among all others."""
    vectors = metric_search.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return metric_search.top_k(metric_search.build_index(vectors), vectors.where(F.col("id") % 20 == 0), 20)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses stated in every document."""
    out = license_scan.scan(_table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), F.array_join("licenses", ",").alias("licenses"), F.size("spans").cast("long").alias("n_spans"),
        F.col("spans")[0]["at"].cast("long").alias("first_sentence"),
    )


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Round trip of every text: number of ids, digests of the ids and of the decoded bytes."""
    import public_tokenizers

    out = byte_bpe.encode_decode(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"])
    return out.select(
        "doc_id", F.size("__bpe.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("__bpe.ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("__bpe.decoded"), 256).alias("decoded_sha256"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, encoded and decoded."""
    return bpe_digests(_table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents by source weights."""
    out = mixing.mix(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", *(F.col(f"__mix.{n}").alias(n) for n in ("size", "source_size", "target", "taken", "copies")))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of every document, read back."""
    path = token_files.fresh_path(spark)
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end=2)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree and unigram log10 probabilities of every document."""
    return context_tree.score(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes and link counts of all documents."""
    return ngram_join.classes(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "n_text_links", "n_copies"
    )


def op11_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"]).select("page_id", "url", "__main.text", "__main.n_chars")


def op12_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (vec_id divisible by 100) and positive among all rows of other labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, 256, F.col("vec_id") % 100 == 0)
    return hard_negatives.mine(rows)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents; every second one is presented without its line feeds."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    docs = _table(spark, sf_dir, "documents")
    out = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], keep=["doc_id"], presented={"text": tampered})
    return out.select(
        "doc_id", "__merkle.leaf", "__merkle.subroot", "__merkle.root", merkle.proof_hash(F.col("__merkle.proof")).alias("proof_sha256"),
        "__merkle.folded_root", "__merkle.verified",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_quality_rules, op2_best_fit_shards, op3_url_filter, op4_metric_topk, op5_license_scan, op6_byte_bpe,
        op7_source_mix, op8_token_files, op9_context_tree, op10_ngram_jaccard, op11_site_style_tree,
        op12_segment_negatives, op13_merkle_manifest, pipeline,
    )
    return {f.__name__: f for f in named}


_USABLE = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"

OP4_SQL = f"""
WITH v AS (SELECT vec_id, row_number() OVER () AS row, [floor(x::DOUBLE * 64) FOR x IN embedding] AS x FROM embeddings WHERE {_USABLE}),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.row <> q.row)
SELECT query_id, (row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

OP12_SQL = f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(x::DOUBLE * 256) FOR x IN embedding] AS x
  FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
scored AS (
  SELECT a.row, a.vec_id AS anchor_id, c.vec_id, c.row AS other, a.label = c.label AS same, list_inner_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.row <> a.row),
positive AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.row, p.other ORDER BY n.score DESC, n.vec_id NULLS LAST))::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.row = p.row AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""

#: A leaf of OP13_SQL: each field's UTF-8 byte count, a colon and the field, or ``-``.
_LEAF = "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

OP13_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
doc AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN xor(list_reduce([4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')],
                                   lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 2 = 0
              THEN {_LEAF.format(text="replace(text, chr(10), '')")} ELSE {_LEAF.format(text="text")} END AS shown
  FROM documents, crc_table),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY grp) AS n FROM doc),
node AS (
  SELECT grp, 0 AS level, r, n, leaf AS h FROM placed
  UNION ALL
  SELECT grp, level + 1, r // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY r)) FROM node WHERE n > 1 GROUP BY grp, level, n, r // 3),
sub AS (SELECT grp, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS r, count(*) OVER () AS n FROM node WHERE n = 1),
high AS (
  SELECT 0 AS level, r, n, subroot AS h FROM sub
  UNION ALL
  SELECT level + 1, r // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY r)) FROM high WHERE n > 1 GROUP BY level, n, r // 3),
inner_step AS (
  SELECT p.grp, p.r AS leaf_rank, node.level, coalesce(string_agg(h, '' ORDER BY node.r) FILTER (node.r < p.r // (3 ** level)::BIGINT), '') AS before,
         coalesce(string_agg(h, '' ORDER BY node.r) FILTER (node.r > p.r // (3 ** level)::BIGINT), '') AS after
  FROM placed p JOIN node ON node.grp = p.grp AND node.n > 1 AND node.r // 3 = p.r // (3 ** (level + 1))::BIGINT GROUP BY p.grp, p.r, node.level),
outer_step AS (
  SELECT s.grp, level, coalesce(string_agg(h, '' ORDER BY high.r) FILTER (high.r < s.r // (3 ** level)::BIGINT), '') AS before,
         coalesce(string_agg(h, '' ORDER BY high.r) FILTER (high.r > s.r // (3 ** level)::BIGINT), '') AS after
  FROM sub s JOIN high ON high.n > 1 AND high.r // 3 = s.r // (3 ** (level + 1))::BIGINT GROUP BY s.grp, level),
step AS (
  SELECT grp, leaf_rank, row_number() OVER (PARTITION BY grp, leaf_rank ORDER BY part, level) AS k, before, after FROM (
    SELECT grp, leaf_rank, 0 AS part, level, before, after FROM inner_step
    UNION ALL SELECT p.grp, p.r, 1, o.level, o.before, o.after FROM placed p JOIN outer_step o ON o.grp = p.grp)),
folded AS (
  SELECT grp, r, 0 AS k, shown AS h FROM placed
  UNION ALL
  SELECT f.grp, f.r, s.k, sha256(s.before || f.h || s.after) FROM folded f JOIN step s ON s.grp = f.grp AND s.leaf_rank = f.r AND s.k = f.k + 1),
proof AS (SELECT grp, leaf_rank, string_agg(before || after, '' ORDER BY k) AS p FROM step GROUP BY grp, leaf_rank)
SELECT p.doc_id, p.leaf, sub.subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(coalesce(proof.p, '')) AS proof_sha256,
       f.h AS folded_root, f.h = (SELECT h FROM high WHERE n = 1) AS verified
FROM placed p JOIN sub ON sub.grp = p.grp
JOIN (SELECT * FROM folded QUALIFY row_number() OVER (PARTITION BY grp, r ORDER BY k DESC) = 1) f ON f.grp = p.grp AND f.r = p.r
LEFT JOIN proof ON proof.grp = p.grp AND proof.leaf_rank = p.r
"""


def llm_oracles() -> dict[str, str]:
    return {"op4_metric_topk": OP4_SQL, "op12_segment_negatives": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
