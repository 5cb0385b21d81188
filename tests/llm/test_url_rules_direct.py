"""Mined URL rules and their matching against every subset of every token set, ties included."""

import random
from collections import Counter
from itertools import combinations

import pytest

from sensorstream.llm import url_filter


def _subsets(tokens):
    return [s for m in range(1, len(tokens) + 1) for s in combinations(sorted(tokens), m)]


def _rules(rows, support, confidence):
    n, seen, with_verdict = len(rows), Counter(), Counter()
    for tokens, verdict in rows:
        for s in _subsets(tokens):
            seen[s] += 1
            with_verdict[s, verdict] += 1
    found = {(s, v): (k / seen[s], k / n) for (s, v), k in with_verdict.items() if k >= support * n and k / seen[s] >= confidence}
    shorter = lambda s, v, c: any(found.get((tuple(t for t in s if t != gone), v), (-1,))[0] >= c for gone in s)
    return {(s, v): x for (s, v), x in found.items() if not shorter(s, v, x[0])}


def _labelled(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(80):
        tokens = {f"t{rng.randrange(7)}" for _ in range(rng.randint(0, 4))}
        bad = {"t0", "t1"} <= tokens or "t5" in tokens and rng.random() < 0.95
        rows.append((sorted(tokens), "block" if bad else "allow"))
    return rows + [rows[3]] * 5


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_and_matches_equal_a_plain_search(spark, seed):
    rows = _labelled(seed)
    frame = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    mined = url_filter.mine(frame, 0.05, 0.8)
    want = _rules(rows, 0.05, 0.8)
    got = {(tuple(r["tokens"]), r["verdict"]): (round(r["confidence"], 9), round(r["support"], 9)) for r in mined.collect()}
    assert got == {k: (round(c, 9), round(s, 9)) for k, (c, s) in want.items()} and len(got) > 3
    # the rules as mined go in, so that equal confidences are equal doubles
    rules = [(r["confidence"], r["support"], len(r["tokens"]), list(r["tokens"]), r["verdict"]) for r in mined.collect()]
    sets = sorted({tuple(sorted({f"t{k}" for k in range(8) if mask >> k & 1})) for mask in range(256)})
    judged = url_filter.match(spark.createDataFrame([(list(s),) for s in sets], "tokens array<string>"), mined)
    found = {tuple(r["judged"]): (r["verdict"], list(r["by"])) for r in judged.collect()}
    best = {s: max(fits) for s in sets if (fits := [r for r in rules if set(r[3]) <= set(s)])}
    assert found == {s: (r[4], r[3]) for s, r in best.items()}


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "tokens array<string>, verdict string")
    assert url_filter.mine(none).count() == 0
    assert url_filter.match(spark.createDataFrame([(["a"],)], "tokens array<string>"), url_filter.mine(none)).count() == 0
