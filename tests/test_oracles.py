"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from compare import compare
from paths import SF_SMALL

from sensorstream.plans.catalog import queries as batch_queries
from sensorstream.streaming.catalog import stream_queries

# the library's own; the optional part's queries are tested in its own folder
NAMES = sorted({**batch_queries(), **stream_queries()})


def test_every_query_has_an_oracle():
    """All of the library's own queries; the optional part's without SQL are held against brute force in its own tests."""
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    diff = compare(df, con, E.oracle_sql()[name])
    assert diff is None, diff


def test_entry_flagship(spark, con):
    assert compare(E.entry(spark), con, E.oracle_sql()["incident_counts"]) is None


def test_incident_goldens_on_typed_readings(spark):
    """Golden counts of FIXTURES.md (typed readings, no malformed messages)."""
    from pyspark.sql import functions as F

    from sensorstream.operators import (explode_alerts, incident_counts, known_sensors, latest_time,
                                        recent_window)
    from sensorstream.sources import tick_readings

    typed = tick_readings(spark.read.parquet(f"{SF_SMALL}/events.parquet")).withColumn("event_time", F.col("rts"))
    known = known_sensors(typed)
    alerts = explode_alerts(recent_window(known, latest_time(known)))
    rows = {r["alert_type"]: r["n_incidents"] for r in incident_counts(alerts).collect()}
    assert sum(rows.values()) == 462
    assert rows == {"Temp. Haute": 84, "Temp. Basse": 79, "Humidité Basse": 89, "Humidité Haute": 84,
                    "Eau Mauvaise": 26, "Insectes": 80, "Mouvement": 20}
