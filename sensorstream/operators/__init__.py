"""DataFrame operators: alert rules, sensor state, incidents, control state."""

from .alerts import (alert_counts, alert_message, alert_messages, alert_table, all_alerts, explode_alerts,
                     first_alert, rule_condition)
from .control import control_state
from .incidents import (alert_gaps, cell_links, cell_summary, incident_counts, incident_sessions,
                        incident_starts, incident_total, incidents_in_horizon)
from .state import (known_sensors, latest_per_sensor, latest_time, panel_humidity, panel_insects, panel_motion,
                    panel_temperature, panel_water, recent_window, update_latest_state)

__all__ = [
    "alert_counts", "alert_message", "alert_messages", "alert_table", "all_alerts",
    "explode_alerts", "first_alert", "rule_condition", "control_state", "alert_gaps", "cell_links",
    "cell_summary", "incident_counts", "incident_sessions", "incident_starts", "incident_total",
    "incidents_in_horizon", "known_sensors", "latest_per_sensor", "latest_time", "panel_humidity",
    "panel_insects", "panel_motion", "panel_temperature", "panel_water", "recent_window",
    "update_latest_state",
]
