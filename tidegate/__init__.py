"""File landing, validation, standardisation and table upkeep as plain Spark jobs."""

from tidegate.session import build_session, work_folder

__all__ = ["build_session", "work_folder"]
