"""Keys that hold most of the rows: right results, spread over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from sensorstream.llm.components import LEAST_CELLS, cells_for, components, with_least


@pytest.fixture
def many_parts(spark):
    """Shuffles keep 64 partitions, and every join shuffles."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _roots(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        up[max(p, q)] = min(p, q)
    return {x: top(x) for x in up}


def test_least_of_a_hot_key_is_spread(spark, many_parts):
    rows = [("hot", f"v{k:05d}") for k in range(9000)] + [(f"k{k % 200}", f"w{k:05d}") for k in range(1000)] + [("hot", "v00000"), (None, "x")]
    df = spark.createDataFrame(rows, "k string, v string")
    out = with_least(df, "k", "v", "m").select("k", "v", "m", F.spark_partition_id().alias("part")).collect()
    least = {}
    for k, v in rows:
        if k is not None:
            least[k] = min(least.get(k, v), v)
    assert sorted((r.k, r.v, r.m) for r in out) == sorted((k, v, least[k]) for k, v in rows if k is not None)
    in_part = {}
    for r in out:
        in_part[r.part] = in_part.get(r.part, 0) + 1
    assert max(in_part.values()) < len(rows) / 10  # one task would hold nine tenths


def test_cells_grow_with_the_rows():
    assert cells_for(0) == cells_for(1000) == LEAST_CELLS
    assert cells_for(10**9) * (1 << 16) >= 10**9


@pytest.mark.parametrize("seed", range(3))
def test_components_with_a_hub(spark, seed):
    rng = random.Random(seed)
    hub = ["m", "a", "z"][seed] + "-hub"  # smaller, larger or amid its neighbours
    edges = [(hub, f"{rng.choice('bnx')}{k:04d}") for k in range(900)]
    edges += [(f"q{k}", f"q{k + 1}") for k in range(30)] + [(f"y{rng.randrange(40)}", f"y{rng.randrange(40)}") for _ in range(30)]
    edges += [("n-tail", edges[0][1]), edges[0], (edges[1][1], hub)]
    found = components(spark.createDataFrame(edges, "u string, v string")).collect()
    wanted = _roots([e for e in edges if e[0] != e[1]])
    assert len(found) == len(wanted) and {r.node: r.root for r in found} == wanted


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0
