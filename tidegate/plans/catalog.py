"""All registered queries."""

from tidegate.plans import q_files, q_profiles, q_reports, q_streams, q_tables, q_tracking  # noqa: F401
from tidegate.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
