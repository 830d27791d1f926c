"""Operators for preparing training text: deduplication, filtering, tokens, packing."""
