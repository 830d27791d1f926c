from millrace.streaming import runner, stateful

__all__ = ["runner", "stateful"]
