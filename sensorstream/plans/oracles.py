"""DuckDB SQL equivalents of the catalog queries (correctness oracles).

The SQL is generated from a rule table of its own, over the
``events`` view, and written independently of the Spark plans (window
functions and a recursive CTE where Spark uses cell aggregates and segments).
"""

from __future__ import annotations

from collections import namedtuple

# Fixed values, stated here a second time so that a wrong constant in the library shows.
_Rule = namedtuple("_Rule", "code label column op threshold message")
RULES = [
    _Rule("High_temperature", "Temp. Haute", "temperature", ">", 40.0, "Alerte ! Le détecteur '{sensor}' détecte une température trop haute."),
    _Rule("Low_temperature", "Temp. Basse", "temperature", "<", 15.0, "Alerte ! Le détecteur '{sensor}' détecte une température trop faible."),
    _Rule("Low_humidity", "Humidité Basse", "humidity", "<", 35.0, "Alerte ! Le détecteur '{sensor}' détecte une humidité trop faible."),
    _Rule("High_humidity", "Humidité Haute", "humidity", ">", 75.0, "Alerte ! Le détecteur '{sensor}' détecte une humidité trop haute."),
    _Rule("Low_Water_Quality", "Eau Mauvaise", "waterQuality", "<", 0.6, "Alerte ! Le détecteur '{sensor}' détecte une qualité de l'eau trop faible."),
    _Rule("Insect_Detected", "Insectes", "insectPresence", "==", 1.0, "Alerte ! Le détecteur '{sensor}' détecte la présence d'un insecte."),
    _Rule("Motion_Detected", "Mouvement", "motion", "==", 1.0, "Alerte ! Le détecteur '{sensor}' détecte du mouvement autour de lui."),
]
VALID_SENSORS = ["sensor_1", "sensor_2", "sensor_3", "sensor_4", "motion_sensor"]
MOTION_SENSOR = "motion_sensor"
PANEL_COLOURS = {
    "temperature": ("#ff4d4d", "#3498db"), "humidity": ("#e67e22", "#2ecc71"), "waterQuality": ("#e74c3c", "#3498db"),
    "motion": ("#c0392b", "#bdc3c7"), "insectPresence": ("#8e44ad", "#bdc3c7"),
}
ACTUATORS = {
    "cooling": dict(start=(">", 40.0), stop=("<=", 30.0), duration=10),
    "heating": dict(start=("<", 15.0), stop=(">=", 30.0), duration=10),
    "humidifying": dict(start=("<", 35.0), stop=(">=", 55.0), duration=10),
    "dehumidifying": dict(start=(">", 75.0), stop=("<=", 55.0), duration=10),
    "purifying": dict(start=("<", 0.6), stop=(">=", 0.8), duration=10),
}
#: Command change per reading: the total change over the steps of 5 s in 10 s.
STEPS = {"cooling": -5.0, "heating": 7.5, "humidifying": 10.0, "dehumidifying": -10.0, "purifying": 0.15}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cond(r) -> str:
    op = "=" if r.op == "==" else r.op
    return f'"{r.column}" {op} CAST({r.threshold!r} AS DOUBLE)'


READINGS = """
field AS (
  SELECT event_id, user_id, k, cents, event_type,
         CASE WHEN user_id % 53 = 7 THEN 'sensor_99' WHEN user_id % 6 <= 1 THEN 'sensor_1' WHEN user_id % 6 = 5 THEN 'motion_sensor'
              ELSE concat('sensor_', CAST(user_id % 6 AS VARCHAR)) END AS sensor_id,
         date_trunc('hour', ts) + INTERVAL 1 SECOND * k
           + INTERVAL 1 MICROSECOND * (CASE WHEN event_type = 'view' THEN epoch_us(ts) % 1000000 ELSE 0 END) AS rts,
         CAST(cents * 10 + k % 2 * 4 AS DOUBLE) / 1000::DOUBLE AS t,
         CASE WHEN k % 10 <> 3 THEN CAST(cents * 7 % 10001 AS DOUBLE) / 100::DOUBLE END AS h,
         CAST(k * 13 % 121 AS DOUBLE) / 100::DOUBLE AS w
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(round("value" * 100) AS BIGINT) AS cents FROM events)
),
readings AS (
  SELECT event_id, user_id, sensor_id,
         CASE WHEN epoch_us(rts) % 1000000 = 0 THEN strftime(rts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(rts, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
         CASE WHEN NOT m THEN t END AS temperature, CASE WHEN NOT m THEN h END AS humidity, CASE WHEN NOT m THEN w END AS "waterQuality",
         CASE WHEN m THEN NULL WHEN event_type = 'error' THEN 1::DOUBLE ELSE 0::DOUBLE END AS "insectPresence",
         CASE WHEN m THEN CASE WHEN event_type IN ('click', 'purchase') THEN 1::DOUBLE ELSE 0::DOUBLE END END AS motion, rts
  FROM (SELECT *, sensor_id = 'motion_sensor' AS m FROM field)
)"""

_FIELDS = ["sensor_id", '"timestamp"', "temperature", "humidity", '"waterQuality"', '"insectPresence"', "motion"]

PARSED = ",\nparsed AS (\n  SELECT event_id, " + ", ".join(
    f"CASE WHEN user_id % 97 = 13 THEN NULL ELSE {f} END AS {f}" for f in _FIELDS
) + ",\n  CASE WHEN user_id % 97 = 13 THEN NULL ELSE rts END AS event_time\n  FROM readings\n)"

_FIRST_CODE = "CASE " + " ".join(f"WHEN {_cond(r)} THEN {_q(r.code)}" for r in RULES) + " END"
_FIRST_VALUE = "CASE " + " ".join(f'WHEN {_cond(r)} THEN CAST("{r.column}" AS VARCHAR)' for r in RULES) + " END"
ENRICHED = f",\nenriched AS (SELECT *, {_FIRST_CODE} AS alert_type, {_FIRST_VALUE} AS alert_value FROM parsed)"

_KNOWN = ", ".join(_q(s) for s in VALID_SENSORS)
KNOWN = f",\nknown AS (SELECT * FROM parsed WHERE sensor_id IN ({_KNOWN}))"
RECENT = (",\nrecent AS (SELECT * FROM known WHERE event_time >= "
          "(SELECT max(event_time) FROM known) - INTERVAL 12 HOUR)")


def _exploded(src: str, name: str) -> str:
    parts = [f"SELECT event_id, sensor_id, event_time, {_q(r.label)} AS alert_type FROM {src} WHERE {_cond(r)}"
             for r in RULES]
    return f",\n{name} AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


GAPS = """,
gaps AS (
  SELECT event_id, sensor_id, alert_type, event_time,
         lag(event_time) OVER (PARTITION BY sensor_id, alert_type ORDER BY event_time, event_id) AS prev_time
  FROM alerts
),
gaps2 AS (
  SELECT *, (epoch_us(event_time) - epoch_us(prev_time)) / 1e6 AS time_diff,
         prev_time IS NULL OR epoch_us(event_time) - epoch_us(prev_time) > 60000000 AS opens
  FROM gaps
)"""

LATEST = """,
latest AS (
  SELECT sensor_id, temperature, humidity, "waterQuality", "insectPresence", motion, event_time, event_id
  FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY event_time DESC, event_id DESC) AS rn
        FROM known WHERE event_time IS NOT NULL)
  WHERE rn = 1
)"""


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts).lstrip(",\n")


_BASE = (READINGS, PARSED)
_MSG = {r.code: r.message.split("{sensor}") for r in RULES}
_MESSAGE = "CASE " + " ".join(
    f"WHEN alert_type = {_q(code)} THEN {_q(pre)} || coalesce(sensor_id, 'None') || {_q(post)}"
    for code, (pre, post) in _MSG.items()
) + " END"


def _level_panel(col: str) -> str:
    alarm, normal = PANEL_COLOURS[col]
    conds = " OR ".join(_cond(r) for r in RULES if r.column == col)
    flag = f"coalesce(({conds}), false)"
    return (_with(*_BASE, KNOWN, LATEST) + f'\nSELECT sensor_id, "{col}" AS value, {flag} AS in_alarm, '
            f"CASE WHEN {flag} THEN {_q(alarm)} ELSE {_q(normal)} END AS colour FROM latest "
            f"WHERE sensor_id <> {_q(MOTION_SENSOR)}")


def _binary_panel(col: str, motion: bool) -> str:
    on, grey = PANEL_COLOURS[col]
    where = f"sensor_id = {_q(MOTION_SENSOR)}" if motion else f"sensor_id <> {_q(MOTION_SENSOR)}"
    return (_with(*_BASE, KNOWN, LATEST) + f'\nSELECT sensor_id, CASE WHEN coalesce("{col}" = 0, false) THEN 0.05::DOUBLE '
            f'ELSE 1.0::DOUBLE END AS value, coalesce("{col}" = 1, false) AS in_alarm, '
            f'CASE WHEN coalesce("{col}" = 1, false) THEN {_q(on)} ELSE {_q(grey)} END AS colour FROM latest WHERE {where}')


def _control_sql() -> str:
    cool, heat, hum, dehum, pur = (ACTUATORS[n] for n in ("cooling", "heating", "humidifying", "dehumidifying", "purifying"))
    return f"""WITH RECURSIVE {READINGS.strip()},
r AS MATERIALIZED (
  SELECT event_id, user_id % 4 + 1 AS s, rts, epoch_us(rts) AS t, t AS T_, h AS H_, w AS W_,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY rts, event_id) - 1 AS k
  FROM field),
c AS (
  SELECT -1::BIGINT AS event_id, s, -1::BIGINT AS k, false AS c, NULL::BIGINT AS ce, false AS h, NULL::BIGINT AS he,
         false AS u, NULL::BIGINT AS ue, false AS d, NULL::BIGINT AS de, false AS p, NULL::BIGINT AS pe
  FROM (SELECT DISTINCT s FROM r)
  UNION ALL
  SELECT event_id, s, k,
         c1 AND NOT (T_ <= {cool['stop'][1]} OR t >= ce1), ce1,
         CASE WHEN c1 THEN h1 ELSE h1 AND NOT (T_ >= {heat['stop'][1]} OR t >= he1) END, he1,
         u1 AND NOT (coalesce(H_ >= {hum['stop'][1]}, false) OR t >= ue1), ue1,
         CASE WHEN u1 THEN d1 ELSE d1 AND NOT (coalesce(H_ <= {dehum['stop'][1]}, false) OR t >= de1) END, de1,
         p1 AND NOT (W_ >= {pur['stop'][1]}::DOUBLE OR t >= pe1), pe1
  FROM (SELECT *,
          CASE WHEN hs THEN false ELSE c0 END AS c1, ce0 AS ce1,
          CASE WHEN hs THEN true ELSE h0 END AS h1, CASE WHEN hs THEN t + {heat['duration']}000000 ELSE he0 END AS he1,
          CASE WHEN ds THEN false ELSE u0 END AS u1, ue0 AS ue1,
          CASE WHEN ds THEN true ELSE d0 END AS d1, CASE WHEN ds THEN t + {dehum['duration']}000000 ELSE de0 END AS de1,
          (p OR W_ < {pur['start'][1]}::DOUBLE) AS p1,
          CASE WHEN W_ < {pur['start'][1]}::DOUBLE AND NOT p THEN t + {pur['duration']}000000 ELSE pe END AS pe1
        FROM (SELECT *, T_ < {heat['start'][1]} AND NOT h0 AS hs, coalesce(H_ > {dehum['start'][1]}, false) AND NOT d0 AS ds FROM (
          SELECT r.event_id, r.s, r.k, r.t, r.T_, r.H_, r.W_, c.p, c.pe,
                 (c.c OR r.T_ > {cool['start'][1]}) AS c0,
                 CASE WHEN r.T_ > {cool['start'][1]} AND NOT c.c THEN r.t + {cool['duration']}000000 ELSE c.ce END AS ce0,
                 CASE WHEN r.T_ > {cool['start'][1]} AND NOT c.c THEN false ELSE c.h END AS h0, c.he AS he0,
                 (c.u OR coalesce(r.H_ < {hum['start'][1]}, false)) AS u0,
                 CASE WHEN coalesce(r.H_ < {hum['start'][1]}, false) AND NOT c.u THEN r.t + {hum['duration']}000000 ELSE c.ue END AS ue0,
                 CASE WHEN coalesce(r.H_ < {hum['start'][1]}, false) AND NOT c.u THEN false ELSE c.d END AS d0, c.de AS de0
          FROM c JOIN r ON r.s = c.s AND r.k = c.k + 1))))
SELECT c.event_id, 'sensor_' || CAST(c.s AS VARCHAR) AS sensor_id,
       r.rts AS event_time,
       c.c AS cooling, c.h AS heating, c.u AS humidifying, c.d AS dehumidifying, c.p AS purifying,
       CASE WHEN c.c THEN {STEPS['cooling']}::DOUBLE
            WHEN c.h THEN {STEPS['heating']}::DOUBLE END AS temperature_command,
       CASE WHEN c.u THEN {STEPS['humidifying']}::DOUBLE
            WHEN c.d THEN {STEPS['dehumidifying']}::DOUBLE END AS humidity_command,
       CASE WHEN c.p THEN {STEPS['purifying']}::DOUBLE END AS water_command
FROM c JOIN r ON r.event_id = c.event_id
WHERE c.event_id >= 0"""


_READ_COLS = 'sensor_id, "timestamp", temperature, humidity, "waterQuality", "insectPresence", motion'
_ENR_COLS = _READ_COLS + ", alert_type, alert_value"


def oracle_sql() -> dict[str, str]:
    alerts_recent = _exploded("recent", "alerts")
    return {
        "parse_readings": _with(*_BASE) + f"\nSELECT event_id, {_READ_COLS}, event_time FROM parsed",
        "normalise_readings": _with(*_BASE) + "\nSELECT event_id, sensor_id, \"timestamp\", "
        + ", ".join(
            f'CASE WHEN "{c}" IS NULL OR isnan("{c}") THEN "{c}" '
            f'ELSE round(greatest({lo}::DOUBLE, least({hi}::DOUBLE, "{c}")), 2) END AS "{c}"'
            for c, (lo, hi) in (("temperature", (10.0, 50.0)), ("humidity", (10.0, 90.0)), ("waterQuality", (0.0, 1.0)))
        ) + ', "insectPresence", motion, event_time FROM parsed',
        "first_alert": _with(*_BASE, ENRICHED) + f"\nSELECT event_id, {_ENR_COLS} FROM enriched",
        "all_alerts_list": _with(*_BASE) + "\nSELECT event_id, NULLIF(concat_ws('|', "
        + ", ".join(f"CASE WHEN {_cond(r)} THEN {_q(r.label)} END" for r in RULES)
        + "), '') AS alert_list, "
        + " + ".join(f"CASE WHEN coalesce({_cond(r)}, false) THEN 1 ELSE 0 END" for r in RULES)
        + " AS n_alerts FROM parsed",
        "all_alerts_exploded": _with(*_BASE, _exploded("parsed", "alerts")) + "\nSELECT * FROM alerts",
        "alert_counts_first_match": _with(*_BASE, ENRICHED)
        + "\nSELECT alert_type, count(*) AS n_readings FROM enriched GROUP BY alert_type",
        "alert_table": _with(*_BASE, ENRICHED)
        + "\nSELECT substring(split_part(\"timestamp\", 'T', 2), 1, 8) AS \"Timestamp\", sensor_id AS \"Sensor\", "
        "alert_type AS \"Alert Type\", alert_value AS \"Value\" FROM enriched WHERE alert_type IS NOT NULL",
        "alert_messages": _with(*_BASE, ENRICHED)
        + f"\nSELECT event_id, sensor_id, alert_type, {_MESSAGE} AS message FROM enriched WHERE alert_type IS NOT NULL",
        "known_sensors": _with(*_BASE, KNOWN) + f"\nSELECT event_id, {_READ_COLS}, event_time FROM known",
        "recent_window": _with(*_BASE, KNOWN, RECENT) + f"\nSELECT event_id, {_READ_COLS}, event_time FROM recent",
        "latest_per_sensor": _with(*_BASE, KNOWN, LATEST) + "\nSELECT * FROM latest",
        "panel_temperature": _level_panel("temperature"),
        "panel_humidity": _level_panel("humidity"),
        "panel_water": _level_panel("waterQuality"),
        "panel_motion": _binary_panel("motion", True),
        "panel_insects": _binary_panel("insectPresence", False),
        "recent_alerts": _with(*_BASE, KNOWN, RECENT, alerts_recent) + "\nSELECT * FROM alerts",
        "alert_gaps": _with(*_BASE, KNOWN, RECENT, alerts_recent, GAPS)
        + "\nSELECT event_id, sensor_id, alert_type, event_time, prev_time, time_diff FROM gaps2",
        "incident_starts": _with(*_BASE, KNOWN, RECENT, alerts_recent, GAPS)
        + "\nSELECT event_id, sensor_id, alert_type, event_time, prev_time, time_diff FROM gaps2 WHERE opens",
        "incident_sessions": _with(*_BASE, KNOWN, RECENT, alerts_recent, GAPS)
        + """,
s AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY sensor_id, alert_type
      ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM gaps2)
SELECT sensor_id, alert_type, min(event_time) AS start_time, max(event_time) AS last_time, count(*) AS n_alerts
FROM s GROUP BY sensor_id, alert_type, sid""",
        "incident_counts": _with(*_BASE, KNOWN, RECENT, alerts_recent, GAPS)
        + "\nSELECT alert_type, count(*) AS n_incidents FROM gaps2 WHERE opens GROUP BY alert_type",
        "incident_total": _with(*_BASE, KNOWN, RECENT, alerts_recent, GAPS)
        + "\nSELECT count(*) AS n_incidents FROM gaps2 WHERE opens",
        "incident_counts_from_sessions": _with(*_BASE, KNOWN, RECENT, alerts_recent, GAPS)
        + "\nSELECT alert_type, count(*) AS n_incidents FROM gaps2 WHERE opens GROUP BY alert_type",
        "archive_json": _with(*_BASE, ENRICHED) + f"\nSELECT event_id, {_ENR_COLS} FROM enriched",
        "publish_roundtrip": _with(READINGS) + f"\nSELECT event_id, {_READ_COLS} FROM readings",
        "control_state": _control_sql(),
        "batch_count": "SELECT count(*) AS n_rows FROM events",
    }
