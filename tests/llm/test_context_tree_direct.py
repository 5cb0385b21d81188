"""Context-tree scores against the recursion written out with dictionaries."""

import math
import random
import zlib
from collections import Counter
from functools import lru_cache

import pytest

from sensorstream.llm import context_tree


def _decisions(byte):
    """(node, bit) of a byte's eight binary decisions."""
    node = 1
    for k in range(7, -1, -1):
        bit = byte >> k & 1
        yield node, bit
        node = node << 1 | bit


def _walk(text, depth):
    """(context, byte) of a text's bytes and its end; a context is the bytes before, the nearest first."""
    raw = bytes([255]) * depth + text + bytes([255])
    for k in range(depth, len(raw)):
        yield tuple(raw[k - 1 : k - 1 - depth : -1] if k - 1 - depth >= 0 else raw[k - 1 :: -1])[:depth], raw[k]


def _direct(train, texts, depth):
    counts, below = Counter(), {}
    for t in train:
        for context, byte in _walk(t, depth):
            for node, bit in _decisions(byte):
                for d in range(depth + 1):
                    counts[context[:d], node, bit] += 1
                    if d:
                        below.setdefault((context[: d - 1], node), set()).add(context[:d])

    def kt(context, node):
        a, b = counts[context, node, 0], counts[context, node, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(maxsize=None)
    def weighted(context, node):
        own = kt(context, node)
        if len(context) == depth:
            return own
        rest = sum(weighted(c, node) for c in below.get((context, node), ()))
        high = max(own, rest)
        return high + math.log(0.5 * math.exp(own - high) + 0.5 * math.exp(rest - high))

    out = []
    for t in texts:
        total = 0.0
        for context, byte in _walk(t, depth):
            for node, bit in _decisions(byte):
                weight, mixed, p = 1.0, 0.0, 0.5
                for d in range(depth + 1):
                    c = context[:d]
                    a, b = counts[c, node, 0], counts[c, node, 1]
                    p = (b + 0.5) / (a + b + 1) if a + b else p
                    stop = 1.0 if d == depth else 0.5 * math.exp(kt(c, node) - weighted(c, node)) if a + b else 0.5
                    mixed, weight = mixed + weight * stop * p, weight * (1 - stop)
                total += math.log10(mixed if bit else 1 - mixed)
        out.append(total)
    return out


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_scores_equal_the_recursion(spark, depth):
    rng = random.Random(depth)
    texts = ["", "a", "abab abab", "é É x", "zz" * 40] + ["".join(rng.choice("abc d") for _ in range(rng.randint(1, 60))) for _ in range(25)]
    # one suffix holds nine tenths of the n-grams
    texts += ["q" * 400, "q" * 300]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "null id"), (100, None)]
    low = [("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")).encode() for _, t in rows]
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0 for k, _ in rows]
    want = _direct([t for t, h in zip(low, held) if not h], low, depth)
    got = context_tree.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), depth=depth).collect()
    assert sorted((str(r["id"]), round(r["score"], 6)) for r in got) == sorted((str(k), round(s, 6)) for (k, _), s in zip(rows, want))
