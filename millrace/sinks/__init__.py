from millrace.sinks import dimensions, external, tables

__all__ = ["dimensions", "external", "tables"]
