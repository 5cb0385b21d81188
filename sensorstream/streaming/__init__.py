"""Structured Streaming jobs and the keyed control-state operator."""

from .control import control_state_stream
from .jobs import (archive_stream, compact_latest_state, incident_sessions_stream, incidents_in_horizon,
                   latest_state_stream, read_latest_state, refresh_latest_state, rolling_incident_counts_stream,
                   rows_dropped_by_watermark, start_archive_and_history,
                   start_dashboard_job, stop_all, watermark_of, with_event_ts)
from .late import late_rows_stream, read_sessions, recount_late
from .live import current_incidents, live_incidents, open_incidents
from .metrics import RunMetrics, counted, run_totals
from .replay import append_closing, closing_stream, event_stream, message_files
from .snapshots import current_state, refresh_state

__all__ = [
    "control_state_stream", "compact_latest_state", "archive_stream", "incident_sessions_stream",
    "incidents_in_horizon", "latest_state_stream", "read_latest_state", "refresh_latest_state", "rolling_incident_counts_stream", "rows_dropped_by_watermark",
    "start_archive_and_history", "start_dashboard_job", "stop_all", "watermark_of", "with_event_ts",
    "append_closing", "closing_stream", "current_incidents", "current_state", "event_stream", "late_rows_stream", "live_incidents",
    "RunMetrics", "counted", "message_files", "open_incidents", "read_sessions", "recount_late", "refresh_state", "run_totals",
]
