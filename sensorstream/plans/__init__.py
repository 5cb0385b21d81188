"""Composed plans: batch jobs, the query catalog and its SQL oracles."""

from .catalog import queries
from .jobs import archive_plan, dashboard, data_anchored_dashboard, enrich, write_dashboard
from .oracles import oracle_sql

__all__ = ["queries", "archive_plan", "dashboard", "data_anchored_dashboard", "enrich", "oracle_sql", "write_dashboard"]
