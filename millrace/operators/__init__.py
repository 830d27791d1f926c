from millrace.operators import bounce, changes, dedup, enrich, joins, routing, unions, visitors, windows

__all__ = ["bounce", "changes", "dedup", "enrich", "joins", "routing", "unions", "visitors", "windows"]
