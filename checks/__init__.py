"""Registered queries, each next to the SQL that has to give the same rows."""

from checks import jobs, row_columns, row_joins, row_sources, row_stateful, row_windows, streams
from checks.base import CATALOG, Check

__all__ = ["CATALOG", "Check", "jobs", "row_columns", "row_joins", "row_sources", "row_stateful", "row_windows", "streams"]
