"""Every operator against brute force, on rows with nulls, empty, long and repeated texts, and on no rows."""

import base64
import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorstream.llm import (
    byte_bpe,
    context_tree,
    license_scan,
    metric_search,
    mixing,
    ngram_join,
    quality_rules,
    sharding,
    token_files,
    url_filter,
)
from sensorstream.llm.catalog import bpe_digests, tokenizer_file

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, extra string, row string"


def _docs():
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(80)]
    texts = [None, "", " \n\t", "one", "a b c d", "a  b c d", "x" * 900, "The MIT license.\nReleased under the MIT License. ok", "\x01 a b"]
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randint(5, 200))) for _ in range(40)]
    base = texts[-1].split() * 3
    near = base[:]
    near[3] = "changed"
    texts += [" ".join(base), " ".join(near), " ".join(base), "\n".join(["same line of text here and there again"] * 9), " ".join(rng.choice(vocab) for _ in range(6000))]
    rows = [(k, t, f"s{k % 4}" if k % 9 else None, "e", "r") for k, t in enumerate(texts)]
    return rows + [rows[12], (None, "null id " * 8, "s1", None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(_docs(), SCHEMA).repartition(3, "doc_id").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_measures(spark, docs):
    labels = spark.createDataFrame([(1, None), (2, 0), (2, 1), (12, 1)], "doc_id long, quality int")
    got = quality_rules.judge(docs, labels).select("text", "row", "__verdict.*").collect()
    assert len(got) == docs.count()
    for r in got:
        text = r["text"] or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        win = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if win[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert r["kept"] == (not r["base_failed"])  # nothing can be learned from these labels


def test_quality_learns_a_clear_rule(spark):
    rows = [(k, " ".join((f"w{k}x{j}###" if k % 3 == 0 else f"w{k}x{j}") for j in range(30))) for k in range(240)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 != 0)) for k in range(200)], "doc_id long, quality int")
    got = quality_rules.judge(frame, labels).select("doc_id", "__verdict.kept").collect()
    assert all(r["kept"] == (r["doc_id"] % 3 != 0) for r in got)


def test_quality_empty(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.keep_good(no_docs, labels).count() == 0


def test_sharding(docs, no_docs):
    got = sharding.shard(docs, 4).select("text", "__shard.*").collect()
    assert len(got) == docs.count()
    shards = {}
    for r in got:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert shards.setdefault(raw, r["shard"]) == r["shard"]
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard(no_docs).count() == 0


def test_best_fit_is_the_tightest_bin():
    assert sharding.best_fit([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]
    rng = random.Random(3)
    sizes = sorted((rng.randint(1, 50) for _ in range(300)), reverse=True)
    room, plain = [], []
    for s in sizes:
        fit = min((i for i, r in enumerate(room) if r >= s), key=lambda i: (room[i], i), default=None)
        if fit is None:
            room.append(100)
            fit = len(room) - 1
        room[fit] -= s
        plain.append(fit)
    assert sharding.best_fit(sizes, 100) == plain


def test_url_filter(spark):
    urls = [None, "no scheme", "http://A.Example.org/es/1", "http://x.org/fr/1", "http://y.net", "http://b.com/de/3?q=1#f", "http://c.com/fr/2", "http://z.net/fr/9", "http://z.net/fr/9"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.judge(pages, min_support=0.1, min_confidence=0.9).collect()}
    assert len(got) == len(urls)
    assert (got[2]["host"], got[2]["path"], got[2]["rule"], got[2]["verdict"]) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (got[5]["rule"], got[5]["verdict"], got[5]["path"]) == ("com/de/", "block", "/de/3")
    assert (got[0]["host"], got[0]["path"], got[0]["rule"], got[0]["verdict"]) == ("", "", None, "allow")
    assert got[7]["rule"] is None and got[7]["mined_tokens"] == ["p:fr"]
    assert url_filter.judge(pages.where("page_id < 0")).count() == 0


def test_metric_search(spark):
    rng = np.random.default_rng(5)
    v = rng.integers(-30, 30, (700, 8)) / 64
    v[100:180] = v[5]
    rows = [(k, [float(x) for x in v[k]], "x") for k in range(700)] + [(700, None, ""), (701, [float("nan")] * 8, ""), (702, [1.0, None], "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").coalesce(2)
    vectors = metric_search.integer_vectors(table)
    queries = vectors.where(F.col("id") % 20 == 0)
    got = metric_search.top_k(metric_search.build_index(vectors, block_rows=300), queries, 6, chunk_queries=20).collect()
    x = np.floor(v * 64).astype(int)
    for q in range(0, 700, 20):
        s = x @ x[q]
        best = sorted((-s[k], k) for k in range(700) if k != q)[:6]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [(k, -m) for m, k in best]
    none = vectors.where("id < 0")
    assert metric_search.top_k(metric_search.build_index(none), none).count() == 0


def test_license_scan(docs, no_docs):
    got = license_scan.scan(docs).collect()
    assert [(r["id"], r["licenses"], [tuple(s) for s in r["spans"]]) for r in got] == [(7, ["MIT"], [(1, 1, "MIT")])]
    assert license_scan.scan(no_docs).count() == 0


def test_license_scan_knows_the_planted_lines(spark):
    """The license lines of the test tables, and the other Creative Commons variants in both forms."""
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
        "All rights reserved.": "All-Rights-Reserved",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    }
    rows = [(k, f"some words\n{line}\nmore words") for k, line in enumerate(lines)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["id"]: (r["licenses"], [tuple(s) for s in r["spans"]]) for r in got} == {k: ([x], [(1, 1, x)]) for k, x in enumerate(lines.values())}


def test_license_scan_finds_every_entry_and_rule(spark):
    """Each listed sentence by its own text, also those with a full stop inside, and each rule by its sentences."""
    names = list(license_scan.SENTENCES)
    rows = [(k, "x y.\n" + license_scan.SENTENCES[n]) for k, n in enumerate(names)]
    one = spark.createDataFrame(rows, "doc_id long, text string")
    got = license_scan.scan(one, rules=[(n, [n]) for n in names]).collect()
    assert {(r["id"], *r["licenses"]) for r in got} == set(enumerate(names)) and len(got) == len(names)
    assert {r["licenses"][0]: (r["spans"][0]["at"], r["spans"][0]["end"]) for r in got}["mpl2-notice"] == (1, 2)
    rows = [(k, "\n".join(license_scan.SENTENCES[i] for i in ids)) for k, (_, ids) in enumerate(license_scan.RULES)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["id"]: r["licenses"] for r in got} == {k: [name] for k, (name, _) in enumerate(license_scan.RULES)}


MIT_BODY = """/*
 * Copyright (c) 2020 Some Body
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all
 * copies or substantial portions of the Software.
 */
code"""
BSD_BODY = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
# 1. Some condition.
# 2. Neither the name of the copyright holder nor the names of its
#    contributors may be used to endorse or promote products derived from
#    this software without specific prior written permission."""


def test_license_scan_of_wrapped_bodies(spark):
    """License bodies over several lines, with comment marks, blank lines and carriage returns."""
    texts = [MIT_BODY, BSD_BODY, MIT_BODY.replace("\n", "\r\n"), "\n".join(BSD_BODY.split()), MIT_BODY.replace("charge,", "charge, or")]
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r["id"]: [tuple(s) for s in r["spans"]] for r in got}
    assert sorted(found) == [0, 1, 2, 3]
    assert found[0] == found[2] == [(3, 11, "MIT")]
    assert {k: r["licenses"] for k, r in ((r["id"], r) for r in got)}[3] == ["BSD-3-Clause"]
    assert [s[2] for s in found[1]] == ["BSD-3-Clause"] and found[1][0][0] == 0


def _scan_by_hand(text):
    """Licenses and spans of a text, by trying every run of sentences."""
    parts = [re.sub("[^a-z0-9]+", " ", p.lower()).strip() for p in re.split(r"\n|(?<=[.!?])[ \t\r]+", text)]
    full = [(k, p) for k, p in enumerate(parts) if p]
    form = {re.sub("[^a-z0-9]+", " ", t.lower()).strip(): n for n, t in license_scan.SENTENCES.items()}
    runs = [(i, j, form[" ".join(p for _, p in full[i:j])]) for i in range(len(full)) for j in range(i + 1, min(len(full), i + 30) + 1) if " ".join(p for _, p in full[i:j]) in form]
    hits = [(k, k + len(ids), name) for k in range(len(runs)) for name, ids in license_scan.RULES if [n for _, _, n in runs[k : k + len(ids)]] == ids]
    hits = [h for h in hits if not any(o[0] <= h[0] and h[1] <= o[1] and o[:2] != h[:2] for o in hits)]
    return sorted((full[runs[a][0]][0], full[runs[b - 1][1] - 1][0], name) for a, b, name in hits)


def test_license_scan_by_hand(spark):
    """Texts of all sentences in any order, wrapped or not, against a plain search over every rule."""
    rng = random.Random(11)
    lines = [*license_scan.SENTENCES.values()]
    starts = ["\n".join(license_scan.SENTENCES[i] for i in ids) for _, ids in license_scan.RULES]
    texts = []
    for _ in range(150):
        some = [rng.choice(rng.choice((lines, starts, ["other words here.", "", "2.0."]))) for _ in range(rng.randint(1, 9))]
        some = [textwrap.fill(x, rng.choice((20, 60, 500)), initial_indent="# ", subsequent_indent="# ") for part in some for x in part.split("\n")]
        texts.append(rng.choice(("\n", "\n\n", "\r\n")).join(some))
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["id"]: [tuple(s) for s in r["spans"]] for r in got} == {k: w for k, t in enumerate(texts) if (w := _scan_by_hand(t))}
    assert all(r["licenses"] == sorted({s["license"] for s in r["spans"]}) for r in got)
    assert {s["license"] for r in got for s in r["spans"]} == {name for name, _ in license_scan.RULES}


def test_license_scan_with_an_own_table(spark):
    """Entries of several sentences, entries of one normal form, and a sentence inside a longer one."""
    table = {"a": "One two. Three!", "b": "Four.", "c": "FOUR", "d": "Four. Five.", "none": "..."}
    rules = [("A", ["a"]), ("AB", ["a", "b"]), ("B", ["b"]), ("C", ["c"]), ("D", ["d"]), ("N", ["none"])]
    texts = ["One two. Three!", "One two.\nThree!\nother\nfour.", "four", "Four. Five. Four.", "One two.", "...", "Three! One two."]
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), table=table, rules=rules).collect()
    assert {r["id"]: [tuple(s) for s in r["spans"]] for r in got} == {
        0: [(0, 1, "A")], 1: [(0, 3, "AB")], 2: [(0, 0, "B"), (0, 0, "C")], 3: [(0, 1, "D"), (2, 2, "B"), (2, 2, "C")],
    }


def test_byte_bpe(docs, no_docs):
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizer_file("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in docs.collect():
        ids = own.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe_digests(docs).collect()) == want
    assert bpe_digests(no_docs).count() == 0


def test_byte_bpe_long_pieces():
    import public_tokenizers
    import tiktoken

    path = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    rng = random.Random(1)
    codec = byte_bpe.Codec(path, public_tokenizers.PATTERN)
    for text in ["a" * 1001, "".join(rng.choice("abcdefth") for _ in range(700)), "".join(chr(rng.randint(33, 0x2FFF)) for _ in range(400)), "a 　\n b\x1c\x85 c  "]:
        ids, counts, back = byte_bpe._encoded(codec, [text])
        assert ids.tolist() == own.encode_ordinary(text) and back == [text.encode()]


def test_mixing(docs, no_docs):
    got = mixing.mix(docs).select("text", "source", "__mix.*").collect()
    size = Counter()
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        size[r["source"]] += r["size"]
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped, total = set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(2 * size[s] for s in capped)
        target = {s: 2.0 * size[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        over = {s for s in free if target[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    largest = max(r["size"] for r in got)
    for s in order:
        mine = [r for r in got if r["source"] == s]
        assert all(math.isclose(r["target"], target[s]) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= largest
    again = mixing.mix(docs.repartition(5)).select("doc_id", "text", "__mix.taken").collect()
    assert Counter((r["text"], r["taken"]) for r in again) == Counter((r["text"], r["taken"]) for r in got)
    assert mixing.mix(no_docs).count() == 0 and mixing.take_mix(docs).columns == docs.columns


def test_token_files(spark, docs, no_docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    own.encode_special_tokens = True
    path = token_files.fresh_path(spark)
    token_files.write_tokens(docs, path, tokenizer_file("word_bpe_49k.json"), end=2)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    want = Counter((r["doc_id"], np.array(own.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for r in docs.collect())
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(len(got))]
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert ids == sorted(ids)
    path = token_files.fresh_path(spark)
    token_files.write_tokens(no_docs, path, tokenizer_file("word_bpe_49k.json"), end=2)
    assert token_files.read_tokens(spark, path).count() == 0


def test_token_files_with_special_strings(spark):
    """Texts that hold the strings of special tokens, against the library's plain call."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    texts = [
        "see <|endoftext|> here", "A<|endoftext|>B. C", "<|startoftext|>", "x <|ENDOFTEXT|> y", "<|StartOfText|>Word, next", "a\n<|endoftext|><|startoftext|>.\nEnd. of",
        "<|endoftext |>", "Plain Text, here. End.", "\x01<|endoftext|> \x01 z", "<|endoftext|>\u0338 <|endoftext|\u226f",
    ]
    assert 49407 in own.encode(texts[0], add_special_tokens=False).ids
    path = token_files.fresh_path(spark)
    token_files.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, tokenizer_file("word_bpe_49k.json"), end=2)
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_files.read_tokens(spark, path).collect()}
    assert got == {k: own.encode(t, add_special_tokens=False).ids + [2] for k, t in enumerate(texts)}


def test_codes_round_trip():
    v = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.int64)
    assert token_files.unpack_codes(*token_files.pack_codes(v), len(v)).tolist() == v.tolist()
    assert token_files.unpack_codes(b"", b"", 0).tolist() == []


def test_context_tree(docs, no_docs):
    rows = docs.collect()
    got = context_tree.score(docs, depth=3).collect()
    assert len(got) == len(rows)
    low = [((r["text"] or "").encode().lower(), zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 10 == 0, r["doc_id"]) for r in rows]
    c, ends = Counter(), sum(not h for _, h, _ in low)
    for t, h, _ in low:
        if not h:
            c.update(t.split())
    n, v = sum(c.values()) + ends, len(c) + 1
    p = lambda x: math.log10((x + 0.1) / (n + 0.1 * (v + 1)))
    want = sorted((str(i), h, len(t.split()) + 1, sum(c[w] > 0 for w in t.split()) + 1, n, round(sum(p(c[w]) for w in t.split()) + p(ends), 6)) for t, h, i in low)
    assert sorted((str(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert context_tree.score(no_docs).count() == 0


def test_context_tree_is_a_distribution(spark):
    """The next byte's probabilities sum to one, in contexts that were trained and in others."""
    train = [(a << 24 | b << 16 | x << 8 | y, 3) for a, b, x, y in ((97, 98, 99, 100), (97, 98, 99, 101), (98, 98, 99, 100))]
    ask = [(97 << 24 | 98 << 16 | 99 << 8 | y, 0) for y in range(256)] + [(1 << 24 | 2 << 16 | 3 << 8 | y, 0) for y in range(256)]
    counts = Counter(dict(ask))
    for g, n in train:
        counts[g] += n
    rows = context_tree.gram_scores(spark.createDataFrame(list(counts.items()), "gram long, n long"), 3).collect()
    for ctx in (97 << 16 | 98 << 8 | 99, 1 << 16 | 2 << 8 | 3):
        assert sum(10 ** r["lp"] for r in rows if r["gram"] >> 8 == ctx) == pytest.approx(1, abs=1e-6)


def test_ngram_join(docs, no_docs):
    rows = docs.collect()
    sets = []
    for r in rows:
        w = WORD.findall(r["text"] or "")
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    equal = lambda a, b: (rows[a]["text"] or "") == (rows[b]["text"] or "")
    near = lambda a, b: equal(a, b) or (sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    links = Counter((rows[a]["doc_id"], sum(bool(near(a, b)) for b in range(len(rows)) if b != a)) for a in range(len(rows)))
    got = ngram_join.classes(docs).collect()
    assert Counter((r["id"], r["n_links"]) for r in got) == links
    assert sum(r["first"] for r in got) == len({r["class_id"] for r in got})
    assert ngram_join.one_of_each(docs).count() == sum(r["first"] for r in got)
    assert ngram_join.classes(no_docs).count() == 0


def test_ngram_join_in_blocks(spark, monkeypatch, tmp_path):
    """A large group of near copies verified block by block has all its links."""
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 8)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(base[:100] + [f"own{k}"] + base[100:])) for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = ngram_join.classes(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 29)}


def test_ngram_join_in_blocks_of_few_texts(spark, monkeypatch, tmp_path):
    """Groups of two long near copies, cut into several blocks by their n-grams, some of them empty: each link is counted once."""
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 60)
    rows = [(2 * g + k, " ".join([f"g{g}w{x}" for x in range(100)] + [f"own{k}"])) for g in range(8) for k in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = ngram_join.classes(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert {(r["id"], r["class_id"], r["n_links"], r["n_text_links"]) for r in got} == {(k, k - k % 2, 1, 1) for k in range(16)}


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows(0.8, 0.9995)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995
