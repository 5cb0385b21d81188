"""Incidents: cell-based operators against a brute-force sequential walk."""

import datetime as dt
import random

import pytest

from sensorstream.operators import alert_gaps, incident_counts, incident_sessions, incident_starts, incident_total

T0 = dt.datetime(2024, 1, 1)
GAP_US = 60_000_000


def _alerts(spark, rows):
    data = [(i, s, a, T0 + dt.timedelta(microseconds=us)) for i, (s, a, us) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id long, sensor_id string, alert_type string, event_time timestamp_ntz")


def _brute(rows, gap_us=GAP_US):
    """Sort by (time, id) per key; a row opens an incident if no predecessor
    or the gap to it is above ``gap_us``. Returns starts {id: prev_us} and sessions."""
    by_key = {}
    for i, (s, a, us) in enumerate(rows):
        by_key.setdefault((s, a), []).append((us, i))
    starts, sessions = {}, []
    for key, items in by_key.items():
        items.sort()
        prev = None
        for us, i in items:
            if prev is None or us - prev > gap_us:
                starts[i] = prev
                sessions.append([key, us, us, 0])
            sessions[-1][2] = us
            sessions[-1][3] += 1
            prev = us
    return starts, sessions


def test_gap_boundary(spark):
    rows = [("s", "a", 0), ("s", "a", 60_000_000), ("s", "a", 120_000_001), ("s", "a", 150_000_000)]
    df = _alerts(spark, rows)
    assert incident_total(df).collect()[0][0] == 2
    sess = sorted((r["n_alerts"], r["start_time"]) for r in incident_sessions(df).collect())
    assert sess == [(2, T0), (2, T0 + dt.timedelta(microseconds=120_000_001))]


def _rows(seed):
    """One key holds most alerts, some in one instant; gaps lie on and next to the bounds."""
    rnd = random.Random(seed)
    t, rows = {}, []
    for _ in range(150):
        key = ("s1", "a") if rnd.random() < 0.7 else (rnd.choice(["s1", "s2"]), rnd.choice(["a", "b"]))
        near = rnd.choice([1000, 60_000_000, 43_200_000_000])
        t[key] = t.get(key, -200_000_000) + rnd.choice([0, 0, 500, near - 1, near, near + 1, rnd.randrange(10**8)])
        rows.append((*key, t[key]))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("gap,gap_us", [("1 millisecond", 1000), ("60 seconds", 60_000_000), ("12 hours", 43_200_000_000)])
def test_any_gap_equals_sequential_walk(spark, many_runs, gap, gap_us):
    rows = _rows(gap_us)
    df = _alerts(spark, rows).repartition(5)
    starts, sessions = _brute(rows, gap_us)
    got = {r["event_id"]: r["prev_time"] for r in incident_starts(df, gap).collect()}
    assert set(got) == set(starts)
    for i, prev in starts.items():
        want = None if prev is None else T0 + dt.timedelta(microseconds=prev)
        assert got[i] == want
    gaps = alert_gaps(df, gap).collect()
    assert len(gaps) == len(rows)
    sess = sorted((r["sensor_id"], r["alert_type"], r["start_time"], r["last_time"], r["n_alerts"])
                  for r in incident_sessions(df, gap).collect())
    want = sorted((k[0], k[1], T0 + dt.timedelta(microseconds=a), T0 + dt.timedelta(microseconds=b), n)
                  for k, a, b, n in sessions)
    assert sess == want
    total = incident_total(df, gap).collect()[0][0]
    assert total == len(starts) == sum(r["n_incidents"] for r in incident_counts(df, gap).collect())


def _operators(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [alert_gaps, incident_starts, incident_sessions, incident_counts, incident_total])
def test_no_window_over_a_whole_key(spark, build):
    """Windows work inside a run, or over one row per run."""
    import re

    plan = _operators(build(_alerts(spark, _rows(1))))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], ", plan.replace("], \n", "], ")) or re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert windows and all("_run" in w for w in windows), windows


def test_scan_carries_over_runs_of_one_key(spark, many_runs):
    """A key over many runs, among them runs without an opening, keeps its order and its owner."""
    from pyspark.sql import functions as F

    from sensorstream.operators.runs import sorted_runs, with_owner, with_previous, with_rank

    n = 4000
    df = spark.range(n).select(F.when(F.col("id") < 50, "a").when(F.col("id") < n - 30, "hot").otherwise("z").alias("k"), F.col("id").alias("t"), (F.col("id") % 1900 == 0).alias("open")).repartition(7)
    runs = sorted_runs(df, ["k"], ["t"])
    assert runs.select("_run").distinct().count() > 2
    with_open = runs.withColumn("open", F.col("open") | F.col("t").isin(50, n - 30))
    got = with_rank(with_owner(with_previous(with_open, ["k"], "t", "prev"), ["k"], "open", "own"), ["k"])
    first = {"a": 0, "hot": 50, "z": n - 30}
    rows = sorted(got.collect(), key=lambda r: r["t"])
    assert [r["prev"] for r in rows] == [None if r["t"] == first[r["k"]] else r["t"] - 1 for r in rows]
    assert [r["_rank"] for r in rows] == [r["t"] - first[r["k"]] for r in rows]
    owners = {}
    for r in rows:
        start = max(o for o in (0, 50, 1900, 3800, n - 30) if o <= r["t"] and o >= first[r["k"]])
        owners.setdefault((r["k"], start), set()).add(tuple(r["own"]))
    assert all(len(v) == 1 for v in owners.values())
    assert len({(k, o) for (k, _), v in owners.items() for o in v}) == len(owners)  # unique within a key
