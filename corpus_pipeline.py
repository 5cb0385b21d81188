"""Corpus pipeline: quality rules, near duplicates, source mix, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last keep the columns of ``documents``. The mix repeats a document's row for
each pass that takes it, so the last stage may have a doc_id twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorstream.llm import mixing, ngram_join, quality_rules
from sensorstream.llm.catalog import bpe_digests
from sensorstream.llm.common import cut


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned rules reject."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return ngram_join.one_of_each(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's documents, one row per pass that takes them."""
    return mixing.take_mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of what they decode to."""
    return bpe_digests(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("source_mix", mix_stage),
    ("byte_bpe", bpe_stage),
]

#: Learned rules, MinHash and BPE have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
