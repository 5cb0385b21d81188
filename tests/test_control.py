"""Controller: hand trace, segment-width invariance, sequential model."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from sensorstream.operators import control_state

T0 = dt.datetime(2024, 1, 1)
FLAGS = ["cooling", "heating", "humidifying", "dehumidifying", "purifying"]


def _readings(spark, rows):
    """rows: (sensor, seconds, T, H, W)."""
    data = [(i, s, T0 + dt.timedelta(seconds=t), T, H, W) for i, (s, t, T, H, W) in enumerate(rows)]
    return spark.createDataFrame(
        data, "event_id long, sensor_id string, event_time timestamp_ntz, temperature double, humidity double, "
              "waterQuality double")


def _sequential_model(rows):
    """Straight per-sensor walk of the rules with one dict of flags per sensor."""
    out = {}
    state = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1], i))
    for i in order:
        s, t, T, H, W = rows[i]
        st_ = state.setdefault(s, {f: False for f in FLAGS} | {f + "_end": None for f in FLAGS})

        def ok(v):
            return v is not None and not (isinstance(v, float) and math.isnan(v))

        def start(flag, other, cond):
            if cond and not st_[flag]:
                st_[flag], st_[flag + "_end"] = True, t + 10
                if other:
                    st_[other], st_[other + "_end"] = False, None

        def stepper(flag, reached):
            if reached:
                st_[flag] = False
            elif t < st_[flag + "_end"]:
                pass
            else:
                st_[flag] = False

        start("cooling", "heating", ok(T) and T > 40)
        start("heating", "cooling", ok(T) and T < 15)
        start("humidifying", "dehumidifying", ok(H) and H < 35)
        start("dehumidifying", "humidifying", ok(H) and H > 75)
        start("purifying", None, ok(W) and W < 0.6)
        if st_["cooling"]:
            stepper("cooling", ok(T) and T <= 30)
        elif st_["heating"]:
            stepper("heating", ok(T) and T >= 30)
        if st_["humidifying"]:
            stepper("humidifying", ok(H) and H >= 55)
        elif st_["dehumidifying"]:
            stepper("dehumidifying", ok(H) and H <= 55)
        if st_["purifying"]:
            stepper("purifying", ok(W) and W >= 0.8)
        out[i] = tuple(st_[f] for f in FLAGS)
    return out


def _flags(df):
    return {r["event_id"]: tuple(r[f] for f in FLAGS) for r in df.collect()}


def test_hand_trace(spark):
    temps = [41.0, 36.0, 31.0, 41.0, 29.0, 14.0, 41.0, 14.0, 30.5]
    rows = [("sensor_1", 5 * k, T, 50.0, 0.7) for k, T in enumerate(temps)]
    got = _flags(control_state(_readings(spark, rows)))
    states = [("cool" if got[i][0] else "heat" if got[i][1] else "idle") for i in range(len(rows))]
    assert states == ["cool", "cool", "idle", "cool", "idle", "heat", "cool", "heat", "idle"]
    cmds = {r["event_id"]: r["temperature_command"] for r in control_state(_readings(spark, rows)).collect()}
    assert cmds[0] == -5.0 and cmds[5] == 7.5 and cmds[2] is None


def _random_rows(seed, n=400):
    rnd = random.Random(seed)
    rows, t = [], {f"sensor_{k}": 0.0 for k in range(1, 4)}
    for _ in range(n):
        s = rnd.choice(list(t))
        t[s] += rnd.choice([0, 1, 2.5, 5, 5, 5, 7, 9.999, 10, 12, 30, 400])
        val = lambda lo, hi: rnd.choice([None, float("nan")]) if rnd.random() < 0.05 else round(rnd.uniform(lo, hi), 2)
        rows.append((s, t[s], val(5, 50), val(20, 90), val(0, 1)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_sequential_model_for_any_segment_size(spark, many_runs, seed, monkeypatch):
    from sensorstream.operators import control

    rows = _random_rows(seed)
    want = _sequential_model(rows)
    df = _readings(spark, rows)
    assert _flags(control_state(df)) == want
    monkeypatch.setattr(control, "GROUP", 4)  # three tiers of composed functions
    for size in (3, 40):
        assert _flags(control_state(df, max_rows_per_segment=size)) == want, size


@pytest.mark.parametrize("seed", [1, 2])
def test_composed_transfers_equal_one_after_the_other(seed):
    from sensorstream.operators.control import CHANNELS, _Transfer, _transfer

    rnd = random.Random(seed)
    t, cut = 0, []
    for _ in range(5):
        times = []
        for _ in range(rnd.randint(1, 9)):
            t += rnd.choice([0, 400_000, 1_000_000, 3_000_000, 11_000_000])
            times.append(t)
        cut.append((times, [round(rnd.uniform(5, 50), 2) for _ in times]))
    ch = CHANNELS[0]
    parts = [_Transfer(_transfer(ch, *c)) for c in cut]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.then(p)
    first = cut[0][0][0]
    for mode, end in [(0, None)] + [(m, first + d) for m in (1, 2) for d in range(-1_000_000, 10_000_000, 250_000)]:
        one = (mode, end)
        for p in parts:
            one = p.at(*one)
        assert whole.at(mode, end) == one


def test_a_burst_in_one_instant_is_cut_by_rank(spark, many_runs, monkeypatch):
    """Readings twenty times the limit at one time: no task gets more than the limit."""
    from sensorstream.operators import control

    limit, seen = 25, spark.sparkContext.accumulator(0)
    whole = control._segment_transfers

    def watched(key, pdf):
        assert len(pdf) <= limit
        seen.add(len(pdf))
        return whole(key, pdf)

    monkeypatch.setattr(control, "_segment_transfers", watched)
    rows = [("sensor_1", 5.0, 20.0 + k % 30, 50.0, 0.7) for k in range(20 * limit)]
    assert _flags(control_state(_readings(spark, rows), max_rows_per_segment=limit)) == _sequential_model(rows)
    assert seen.value >= len(rows)


@pytest.mark.parametrize("seed", [7, 8])
def test_stream_matches_sequential_model_across_batches(spark, seed):
    from sensorstream.session import scratch_path
    from sensorstream.streaming import control_state_stream

    rows = _random_rows(seed, n=300)
    want = _sequential_model(rows)
    df = _readings(spark, rows)
    src = scratch_path(spark, "ctl-rand")
    # time-ordered files: cut at three instants so actuator end times straddle batches
    order = sorted(range(len(rows)), key=lambda i: rows[i][1])
    cuts = [rows[order[len(order) * k // 4]][1] for k in (1, 2, 3)]
    bounds = [float("-inf"), *cuts, float("inf")]
    secs = (F.unix_micros(F.col("event_time").cast("timestamp")) - F.lit(1704067200000000)) / 1e6
    for lo, hi in zip(bounds, bounds[1:]):
        df.filter((secs >= lo) & (secs < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(src)
    out, ck = scratch_path(spark, "ctl-rand-out"), scratch_path(spark, "ctl-rand-ck")
    q = (control_state_stream(stream).writeStream.format("parquet").option("checkpointLocation", ck)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert _flags(spark.read.parquet(out)) == want


@pytest.mark.parametrize("seed", range(6))
def test_transfer_table_equals_full_replay_per_hypothesis(seed):
    """Every possible incoming state, replayed in full, lands on the row the
    transfer table gives for it."""
    from sensorstream.operators.control import CHANNELS, INCOMING, _transfer, step

    rnd = random.Random(seed)
    n = 60
    times, t = [], 0
    for _ in range(n):
        t += rnd.choice([0, 100_000, 250_000, 1_000_000, 3_000_000])  # dense: many readings in 10 s
        times.append(t)
    for ch in CHANNELS:
        lo_v, hi_v = (0.0, 1.0) if ch.measure == "waterQuality" else (5.0, 90.0)
        xs = [float("nan") if rnd.random() < 0.05 else round(rnd.uniform(lo_v, hi_v), 2) for _ in range(n)]
        rows = _transfer(ch, times, xs)
        for m in range(1, len(ch.names) + 1):
            for e in sorted({tt + d for tt in times for d in (0, 1)} | {times[0] - 5}):
                if e >= times[0] + ch.durations[m - 1]:
                    continue
                mode, end = m, INCOMING
                for i in range(n):
                    mode, end = step(ch, mode, end, xs[i], times[i], times[i] < e)
                want = (mode, None if end == INCOMING else end, end == INCOMING)
                row = next(r for r in rows if r[0] == m and (r[1] is None or r[1] < e) and (r[2] is None or e <= r[2]))
                assert row[3:] == want, (ch.measure, m, e)


def test_null_tie_does_not_fail_batch_or_stream(spark):
    from sensorstream.session import scratch_path
    from sensorstream.streaming import control_state_stream

    schema = "event_id long, sensor_id string, event_time timestamp_ntz, temperature double, humidity double, waterQuality double"
    rows = [(None, "sensor_1", T0, 41.0, 50.0, 0.7), (2, "sensor_1", T0 + dt.timedelta(seconds=5), 36.0, 50.0, 0.7),
            (None, "sensor_1", T0 + dt.timedelta(seconds=5), 36.0, 50.0, 0.7)]
    df = spark.createDataFrame(rows, schema)
    batch = sorted((r["event_id"] or -1, r["cooling"]) for r in control_state(df).collect())
    src, out, ck = scratch_path(spark, "nt-src"), scratch_path(spark, "nt-out"), scratch_path(spark, "nt-ck")
    df.coalesce(1).write.mode("append").parquet(src)
    q = (control_state_stream(spark.readStream.schema(df.schema).parquet(src)).writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    stream = sorted((r["event_id"] or -1, r["cooling"]) for r in spark.read.parquet(out).collect())
    assert batch == stream == [(-1, True), (-1, True), (2, True)]


def test_two_column_tie_keeps_rows_from_other_partitions(spark):
    from sensorstream.session import scratch_path
    from sensorstream.streaming import control_state_stream

    schema = ("partition int, offset long, sensor_id string, event_time timestamp_ntz, temperature double, "
              "humidity double, waterQuality double")
    t = T0 + dt.timedelta(seconds=5)
    first = [(0, 5, "sensor_1", T0, 41.0, 50.0, 0.7), (0, 6, "sensor_1", t, 41.0, 50.0, 0.7)]
    second = [(1, 6, "sensor_1", t, 20.0, 50.0, 0.7)]  # same time and offset, other partition, next batch
    batch = control_state(spark.createDataFrame(first + second, schema), tie_col=("partition", "offset"))
    assert batch.count() == 3
    src, out, ck = scratch_path(spark, "tie2-src"), scratch_path(spark, "tie2-out"), scratch_path(spark, "tie2-ck")
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(src)
    q = (control_state_stream(stream, tie_col=("partition", "offset")).writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    got = sorted((r["event_time"], r["partition"], r["offset"], r["cooling"]) for r in spark.read.parquet(out).collect())
    want = sorted((r["event_time"], r["partition"], r["offset"], r["cooling"]) for r in batch.collect())
    assert got == want and [g[1:3] for g in got] == [(0, 5), (0, 6), (1, 6)]  # rows can be joined back


def test_transfer_is_linear_on_a_sensor_stuck_in_alarm():
    import time

    from sensorstream.operators.control import CHANNELS, _transfer

    n = 40_000
    t0 = time.perf_counter()
    rows = _transfer(CHANNELS[0], list(range(0, 1000 * n, 1000)), [41.0] * n)  # 1 kHz for 40 seconds
    assert time.perf_counter() - t0 < 5 and len(rows) <= n + 3


def test_late_rows_of_the_stream_come_out_without_flags(spark):
    from sensorstream.session import scratch_path
    from sensorstream.streaming import control_state_stream

    src, out, ck = (scratch_path(spark, n) for n in ("ctl-late", "ctl-late-out", "ctl-late-ck"))
    first, second = [("sensor_1", 100, 41.0, 50.0, 0.7)], [("sensor_1", 20, 10.0, 50.0, 0.7), ("sensor_1", 105, 36.0, 50.0, 0.7)]
    df = _readings(spark, first + second)
    df.where("event_id < 1").coalesce(1).write.mode("append").parquet(src)
    df.where("event_id >= 1").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(src)
    q = control_state_stream(stream).writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    q.awaitTermination()
    got = {r["event_id"]: (r["cooling"], r["heating"], r["temperature_command"]) for r in spark.read.parquet(out).collect()}
    assert got == {0: (True, False, -5.0), 1: (None, None, None), 2: (True, False, -5.0)}
