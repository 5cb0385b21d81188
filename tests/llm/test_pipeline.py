"""The corpus pipeline's rows against plain Python versions of its four stages."""

import hashlib
import json
import math
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from sensorstream.llm.catalog import tokenizer_file

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _docs():
    """Good documents, junk (three marks a word), near and exact copies across sources, nulls, an empty and a short text."""
    rng, rows = random.Random(11), []
    for k in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(25, 120))]
        if k % 5 == 0:
            words = [w + "###" for w in words]
        rows.append([k, " ".join(words), "en", f"s{k % 3}" if k % 11 else None, 1])
    for k in range(150, 170):
        words = rows[(k - 150) // 4 * 5 + 1][1].split()
        if k % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append([k, " ".join(words), "en", f"s{k % 3}", None])
    rows += [[170, None, None, None, None], [171, "", "en", "s1", 0], [172, "too short a text", "en", "s1", 1], [173, "again and again " * 60, "en", "s2", 1]]
    return [tuple(r) for r in rows]


def _good(rows):
    """The base rule; and what the labels say: marks mean bad."""
    kept = []
    for r in rows:
        w = WORD.findall(r[1] or "")
        win = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if win[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        if len(w) >= 20 and 100 * len(covered) <= 30 * len(w) and "#" not in r[1]:
            kept.append(r)
    return kept


def _one_of_each(rows):
    """Smallest id of each class of texts with five-word Jaccard of 0.8 or more."""
    grams = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (WORD.findall(r[1]) for r in rows)]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][1] == rows[b][1] or len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [r for k, r in enumerate(rows) if find(k) == k]


def _targets(rows):
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1]))
    order = sorted(s for s in size if s is not None) + [None] * (None in size)
    weight, capped, total = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(2 * size[s] for s in capped)
        target = {s: 2.0 * size[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        over = {s for s in free if target[s] > 2 * size[s]}
        if not over:
            return target
        capped |= over


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(_docs(), SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int("#" not in (r[1] or "")), 0) for r in _docs() if r[0] < 140] + [(999, 1, 0), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    models = [_good, _one_of_each]
    rows = _docs()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard", "source_mix", "byte_bpe"]
    for (name, stage), model in zip(corpus_pipeline.STAGES, models):
        docs, rows = stage(spark, docs, folder), model(rows)
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
        assert sorted(map(tuple, docs.collect())) == sorted(rows), name


def test_run(spark, folder):
    import public_tokenizers
    import tiktoken

    rows = _one_of_each(_good(_docs()))
    text = {r[0]: r[1] for r in rows}
    out = corpus_pipeline.run(spark, folder).collect()
    taken = Counter(r["doc_id"] for r in out)
    assert set(taken) <= set(text) and max(taken.values()) <= 2
    words = {k: len(WORD.findall(t)) for k, t in text.items()}
    largest = max(words.values())
    for s, target in _targets(rows).items():
        mixed = sum(taken[r[0]] * words[r[0]] for r in rows if r[3] == s)
        assert math.isclose(mixed, target, abs_tol=largest)
    from tiktoken.load import load_tiktoken_bpe

    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(tokenizer_file("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in out:
        ids = plain.encode_ordinary(text[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_run_on_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert json.dumps(corpus_pipeline.ORACLE_SQL) == "null"
