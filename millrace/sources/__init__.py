from millrace.sources import lookups, sample, topics

__all__ = ["lookups", "sample", "topics"]
