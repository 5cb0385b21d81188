"""Alert rules, sensor whitelist, panel colours and controller settings.

The rule table is data: each rule names a measurement, a strict comparison
and a threshold, plus the three texts the applications attach to it. The
order of ``RULES`` is the first-match precedence.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    order: int
    code: str  # label written by the archive job
    label: str  # label shown by the dashboard
    column: str
    op: str  # one of ">", "<", "=="
    threshold: float
    message: str  # notification text, ``{sensor}`` is replaced by the sensor id


# --- Fixed values: these must equal the original application's ---------------
# Thresholds: temperature > 40.0 / < 15.0, humidity < 35.0 / > 75.0,
# waterQuality < 0.6, insectPresence == 1, motion == 1 (all strict).
RULES: tuple[Rule, ...] = (
    Rule(1, "High_temperature", "Temp. Haute", "temperature", ">", 40.0,
         "Alerte ! Le détecteur '{sensor}' détecte une température trop haute."),
    Rule(2, "Low_temperature", "Temp. Basse", "temperature", "<", 15.0,
         "Alerte ! Le détecteur '{sensor}' détecte une température trop faible."),
    Rule(3, "Low_humidity", "Humidité Basse", "humidity", "<", 35.0,
         "Alerte ! Le détecteur '{sensor}' détecte une humidité trop faible."),
    Rule(4, "High_humidity", "Humidité Haute", "humidity", ">", 75.0,
         "Alerte ! Le détecteur '{sensor}' détecte une humidité trop haute."),
    Rule(5, "Low_Water_Quality", "Eau Mauvaise", "waterQuality", "<", 0.6,
         "Alerte ! Le détecteur '{sensor}' détecte une qualité de l'eau trop faible."),
    Rule(6, "Insect_Detected", "Insectes", "insectPresence", "==", 1.0,
         "Alerte ! Le détecteur '{sensor}' détecte la présence d'un insecte."),
    Rule(7, "Motion_Detected", "Mouvement", "motion", "==", 1.0,
         "Alerte ! Le détecteur '{sensor}' détecte du mouvement autour de lui."),
)

VALID_SENSORS: tuple[str, ...] = ("sensor_1", "sensor_2", "sensor_3", "sensor_4", "motion_sensor")
MOTION_SENSOR = "motion_sensor"

ALERT_HORIZON = "12 hours"
INCIDENT_GAP = "60 seconds"

# Panel colours: (alarm, normal) per panel; grey marks an idle binary sensor.
PANEL_COLOURS = {
    "temperature": ("#ff4d4d", "#3498db"),
    "humidity": ("#e67e22", "#2ecc71"),
    "waterQuality": ("#e74c3c", "#3498db"),
    "motion": ("#c0392b", "#bdc3c7"),
    "insectPresence": ("#8e44ad", "#bdc3c7"),
}
# Binary panels draw 0 as a short bar and anything else as a full bar.
IDLE_LEVEL, ACTIVE_LEVEL = 0.05, 1.0

# Actuator controller: (start threshold, stop target, total change, duration s).
# cooling starts above 40.0, stops at or below 30.0, total change -10.0 over 10 s;
# heating starts below 15.0, stops at or above 30.0, +15.0 over 10 s;
# humidifying starts below 35.0, stops at or above 55.0, +20.0 over 10 s;
# dehumidifying starts above 75.0, stops at or below 55.0, -20.0 over 10 s;
# purifying starts below 0.6, stops at or above 0.8, +0.3 over 10 s.
CONTROL_STEP_SECONDS = 5
ACTUATORS = {
    "cooling": dict(measure="temperature", start=(">", 40.0), stop=("<=", 30.0), total=-10.0, duration=10),
    "heating": dict(measure="temperature", start=("<", 15.0), stop=(">=", 30.0), total=15.0, duration=10),
    "humidifying": dict(measure="humidity", start=("<", 35.0), stop=(">=", 55.0), total=20.0, duration=10),
    "dehumidifying": dict(measure="humidity", start=(">", 75.0), stop=("<=", 55.0), total=-20.0, duration=10),
    "purifying": dict(measure="waterQuality", start=("<", 0.6), stop=(">=", 0.8), total=0.3, duration=10),
}
# -----------------------------------------------------------------------------

# Actuators that share a measurement exclude each other: starting one clears the
# other, and only the first active one of a pair is stepped. Purifying is alone.
ACTUATOR_CHANNELS = (
    ("temperature", ("cooling", "heating")),
    ("humidity", ("humidifying", "dehumidifying")),
    ("waterQuality", ("purifying",)),
)


def step_size(name: str) -> float:
    """Command change per reading while an actuator runs."""
    a = ACTUATORS[name]
    steps = max(1, int(a["duration"] / CONTROL_STEP_SECONDS))
    return a["total"] / steps


def rule_by_code(code: str) -> Rule:
    return next(r for r in RULES if r.code == code)
