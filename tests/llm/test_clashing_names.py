"""Input columns named like the operators' own: nothing crashes, and every value stays."""

import pytest
from pyspark.sql import functions as F

from sensorstream.llm import byte_bpe, html_extract, merkle, mixing, ngram_join, quality_rules, sharding, url_filter
from sensorstream.llm.catalog import tokenizer_file

INNER = ("row", "o", "crc", "grp", "g", "part", "block", "b", "bytes", "f", "s", "file", "index", "n", "first", "shift", "size", "id", "rid", "key", "k", "first_rid")
RESERVED = ("__quality_measures", "__first_rid", "__rid", "__verdict", "__shard", "__mix", "__mix_row", "__bpe", "__main", "__merkle", "__id", "a.b", "doc")


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clash"))
    texts = [None, "", *(" ".join(f"w{k}x{j}" for j in range(40)) for k in range(12)), " ".join(f"w3x{j}" for j in range(40))]
    rows = spark.createDataFrame([(k, t, f"s{k % 3}") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    extra = [F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in (*INNER, *RESERVED)]
    rows.select("*", *extra).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _intact(frame, without=()):
    """Every row's extra values are those of its doc_id."""
    names = [c for c in (*INNER, *RESERVED) if c not in without]
    for r in frame.select("doc_id", *(F.col(f"`{c}`") for c in names)).collect():
        assert all(r[c] == f"{c}-{r['doc_id']}" for c in names)
    return frame


def test_quality_rules(spark, docs):
    labels = spark.createDataFrame([(2, 1), (3, 0)], "doc_id long, quality int")
    kept = _intact(quality_rules.keep_good(docs, labels))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == list(range(2, 15))
    judged = _intact(quality_rules.judge(docs, labels), {"__verdict"})
    assert judged.where("__verdict.base_failed").count() == 2 and judged.columns.count("__verdict") == 1


def test_quality_rules_keep_nothing(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.judge(docs, labels, keep=[]).columns == ["__verdict"]


def test_sharding(docs):
    out = _intact(sharding.shard(docs, 4), {"__shard"})
    assert out.count() == 15 and out.select("__shard.shard", "__shard.slot").distinct().count() == 15


def test_one_of_each(docs):
    out = _intact(ngram_join.one_of_each(docs))
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == [0, *range(2, 14)]  # 0 and 1 are empty, 14 a copy of 5


def test_mixing(docs):
    out = _intact(mixing.take_mix(docs))
    assert out.columns == docs.columns and out.count() > 0


def test_byte_bpe(docs):
    import public_tokenizers

    out = _intact(byte_bpe.encode_decode(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), {"__bpe"})
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in out.select("text", "__bpe.decoded").collect())


def test_html_and_manifest(docs):
    pages = docs.withColumn("url", F.concat(F.lit("http://h.org/"), "doc_id")).withColumn("html", F.concat(F.lit("<p>"), "text", F.lit("</p>")))
    out = _intact(html_extract.extract(pages), {"__main"})
    assert all(r["text"] == (r["t"] or "") for r in out.select(F.col("text").alias("t"), "__main.text").collect())
    out = _intact(merkle.manifest(docs, ["doc_id", "source", "text"]), {"__merkle"})
    assert out.where("__merkle.verified").count() == 15


@pytest.mark.parametrize("least", [1, 2, 3, 4])
def test_a_mined_rule_rests_on_enough_pages(spark, least):
    labelled = spark.createDataFrame([(["p:x"], "block")] * 3 + [(["p:y"], "allow")] * 2 + [(["p:z"], "block")], "tokens array<string>, verdict string")
    got = {r["tokens"][0] for r in url_filter.mine(labelled, 0.01, 0.9, least).collect()}
    assert got == {t for t, n in (("p:x", 3), ("p:y", 2), ("p:z", 1)) if n >= least}
