
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorstream.functions import parse_readings
from sensorstream.operators import all_alerts, first_alert
from sensorstream.plans import archive_plan, data_anchored_dashboard
from sensorstream.rules import RULES
from sensorstream.sources import raw_messages

from paths import SF_SMALL

value = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 15.0, 35.0, 40.0, 75.0, 0.6, 14.99, 40.01, 80.0]),
                  st.floats(min_value=0, max_value=100, allow_nan=False))
reading = st.fixed_dictionaries({"temperature": value, "humidity": value, "waterQuality": value,
                                 "insectPresence": value, "motion": value})


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(reading, min_size=1, max_size=30))
def test_first_match_is_first_of_all_matches(spark, rows):
    msgs = spark.createDataFrame([(i, json.dumps({"sensor_id": "s", **r})) for i, r in enumerate(rows)],
                                 "event_id long, value string")
    df = all_alerts(first_alert(parse_readings(msgs, keep=("event_id",))))
    label = {r.code: r.label for r in RULES}
    for r in df.collect():
        first = None if r["alert_list"] is None else r["alert_list"][0]
        assert (None if r["alert_type"] is None else label[r["alert_type"]]) == first


def test_dashboard_job(spark):
    msgs = raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    dash = data_anchored_dashboard(parse_readings(msgs, keep=("event_id",)))
    assert dash.total.collect()[0]["n_incidents"] == sum(r["n_incidents"] for r in dash.incidents.collect())
    assert sorted(r["sensor_id"] for r in dash.state.collect()) == [
        "motion_sensor", "sensor_1", "sensor_2", "sensor_3", "sensor_4"]
    assert dash.temperature.count() == 4 and dash.motion.count() == 1 and dash.insects.count() == 4


def test_dashboard_with_stored_state(spark):
    from sensorstream.operators import latest_per_sensor
    from sensorstream.plans import dashboard

    readings = parse_readings(raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet")), keep=("event_id",))
    stored = latest_per_sensor(readings.drop("timestamp"))  # includes unknown sensors; the job filters them
    dash = dashboard(readings, state=stored)
    assert sorted(r["sensor_id"] for r in dash.temperature.collect()) == ["sensor_1", "sensor_2", "sensor_3", "sensor_4"]


def test_archive_job(spark):
    msgs = raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    out = archive_plan(msgs)
    assert out.archive.count() == 1000
    n_alerts = out.table.count()
    assert n_alerts == out.messages.count() == out.messages.filter(F.col("message").isNotNull()).count()
    doc = json.loads(out.archive.filter(F.col("key") == "13").collect()[0]["value"])
    assert set(doc) == {"sensor_id", "timestamp", "temperature", "humidity", "waterQuality", "insectPresence",
                        "motion", "alert_type", "alert_value"} and all(v is None for v in doc.values())


def test_incremental_latest_state_equals_full(spark):
    from sensorstream.operators import known_sensors, latest_per_sensor, update_latest_state

    readings = known_sensors(parse_readings(raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet")),
                                            keep=("event_id",))).drop("timestamp")
    full = latest_per_sensor(readings)
    state = latest_per_sensor(readings.filter(F.col("event_id") < 400))
    for lo, hi in [(400, 700), (700, 10**9)]:
        state = update_latest_state(state, readings.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)))
    assert sorted(tuple(r) for r in state.collect()) == sorted(tuple(r) for r in full.select(*state.columns).collect())


measure = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([0.0, 1.0, 15.0, 35.0, 40.0, 75.0, 0.6]),
                    st.floats(min_value=-10, max_value=120, allow_nan=False).map(lambda v: round(v, 2)))
full_reading = st.fixed_dictionaries({c: measure for c in ("temperature", "humidity", "waterQuality",
                                                           "insectPresence", "motion")})


def _model_first(r):
    """Plain-Python model of the first-match rule chain (NaN and null break no rule)."""
    def ok(v):
        return v is not None and v == v
    checks = [("High_temperature", "temperature", lambda v: v > 40.0), ("Low_temperature", "temperature", lambda v: v < 15.0),
              ("Low_humidity", "humidity", lambda v: v < 35.0), ("High_humidity", "humidity", lambda v: v > 75.0),
              ("Low_Water_Quality", "waterQuality", lambda v: v < 0.6), ("Insect_Detected", "insectPresence", lambda v: v == 1.0),
              ("Motion_Detected", "motion", lambda v: v == 1.0)]
    for code, col, test in checks:
        if ok(r[col]) and test(r[col]):
            return code, r[col]
    return None, None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(full_reading, min_size=1, max_size=30))
def test_first_alert_matches_python_model(spark, rows):
    from pyspark.sql import types as T

    cols = ("temperature", "humidity", "waterQuality", "insectPresence", "motion")
    schema = T.StructType([T.StructField("event_id", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in cols])
    df = spark.createDataFrame([(i, *(r[c] for c in cols)) for i, r in enumerate(rows)], schema)
    got = {r["event_id"]: (r["alert_type"], r["alert_value"]) for r in first_alert(df).collect()}
    for i, r in enumerate(rows):
        code, value = _model_first(r)
        assert got[i][0] == code
        if code is not None:
            assert float(got[i][1]) == value  # the value as text parses back to the measurement


def _half_up(v, lo, hi):
    from decimal import ROUND_HALF_UP, Decimal

    if v is None or v != v:
        return v
    c = max(lo, min(hi, v))
    return float(Decimal(repr(c)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.floats(min_value=-50, max_value=150, allow_nan=False))] * 3),
                min_size=1, max_size=30))
def test_normalise_matches_python_model(spark, rows):
    from sensorstream.functions import normalise_readings

    df = spark.createDataFrame(rows, "temperature double, humidity double, waterQuality double")
    got = [tuple(r) for r in normalise_readings(df).collect()]
    want = [(_half_up(t, 10.0, 50.0), _half_up(h, 10.0, 90.0), _half_up(w, 0.0, 1.0)) for t, h, w in rows]
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet="T0123456789:-. x", max_size=40)), min_size=1, max_size=40))
def test_display_time_matches_text_model(spark, texts):
    from sensorstream.functions import display_time

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r["i"]: r["d"] for r in df.select("i", display_time("t").alias("d")).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else (t.split("T")[1][:8] if "T" in t else "")
        assert got[i] == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(max_size=60),
                          st.dictionaries(st.sampled_from(["sensor_id", "temperature", "humidity", "motion", "x"]),
                                          st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False),
                                                    st.text(max_size=5), st.integers(-5, 5))).map(json.dumps)),
                min_size=1, max_size=40))
def test_parsing_never_fails_or_drops_rows(spark, values):
    msgs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id long, value string")
    rows = all_alerts(first_alert(parse_readings(msgs, keep=("event_id",)))).collect()
    assert sorted(r["event_id"] for r in rows) == list(range(len(values)))


def test_dashboard_with_sensor_registry(spark):
    from sensorstream.plans import dashboard

    readings = parse_readings(raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet")), keep=("event_id",))
    registry = spark.createDataFrame([("sensor_1",), ("motion_sensor",)], "sensor_id string")
    dash = dashboard(readings, sensors=registry)
    assert sorted(r["sensor_id"] for r in dash.state.collect()) == ["motion_sensor", "sensor_1"]
    assert [r["sensor_id"] for r in dash.temperature.collect()] == ["sensor_1"]


def test_write_dashboard_tables(spark):
    from sensorstream.plans import write_dashboard
    from sensorstream.session import scratch_path

    readings = parse_readings(raw_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet")), keep=("event_id",))
    root = scratch_path(spark, "dash-tables")
    write_dashboard(data_anchored_dashboard(readings), root)
    assert spark.read.parquet(f"{root}/temperature").count() == 4
    assert spark.read.parquet(f"{root}/total").collect()[0]["n_incidents"] == \
        sum(r["n_incidents"] for r in spark.read.parquet(f"{root}/incidents").collect())
