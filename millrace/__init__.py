"""millrace: warehouse operators and jobs for PySpark, batch and streaming."""

from millrace.session import build_session, tune

__all__ = ["build_session", "tune"]
