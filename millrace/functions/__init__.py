from millrace.functions import cdc, text, times, values

__all__ = ["cdc", "text", "times", "values"]
