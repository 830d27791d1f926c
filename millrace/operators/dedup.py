"""One row per key: the first, or the latest version.

Both are aggregates, so each task reduces its own rows before the shuffle and a key that holds a large share
of the rows never has to be sorted in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import times

Order = list[str | Column]


def _pick(df: DataFrame, keys: list[str], order: Order, how, columns: list[str] | None) -> DataFrame:
    out = columns or df.columns
    carried = [c for c in out if c not in keys]
    row = F.struct(*carried) if carried else F.lit(True)
    kept = df.groupBy(*keys).agg(how(row, F.struct(*order)).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in out])


def first_row(df: DataFrame, keys: list[str], order: Order, columns: list[str] | None = None) -> DataFrame:
    return _pick(df, keys, order, F.min_by, columns)


def latest_row(df: DataFrame, keys: list[str], order: Order, columns: list[str] | None = None) -> DataFrame:
    """``columns`` cuts the rows down before they are shuffled."""
    return _pick(df, keys, order, F.max_by, columns)


def latest_version(
    df: DataFrame, keys: list[str], version: str, seq: str, columns: list[str] | None = None, clock: str = "EventTime"
) -> DataFrame:
    """Latest version per key, ties to the later arrival; works on batch tables and on streams.

    Versions are compared as times, also where they are text. A missing or unreadable one counts as the earliest.

    A stream gives the rows of a key a settling time, counted from the first of them, and then emits the
    latest (see ``streaming.stateful.settle_latest``); ``clock`` says whether by the watermark or by the time of the machine.
    """
    if df.isStreaming:
        from millrace.streaming.stateful import settle_latest

        return settle_latest(df, keys, version, seq, clock=clock).select(*(columns or df.columns))
    return latest_row(df, keys, [times.version_time(version), F.col(seq)], columns)
