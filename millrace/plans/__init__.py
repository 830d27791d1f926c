from millrace.plans import ads, dim, dwd, dws

__all__ = ["ads", "dim", "dwd", "dws"]
