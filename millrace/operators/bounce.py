"""Bounces: an entry page that no ordinary page follows in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: time within which the next page has to follow.
WITHIN_SECONDS = 10

#: Length of a time slice, in multiples of the waiting time.
SLICE = 30


_SLICES = ["_in", "_own", "_entry"]


def _sliced(df: DataFrame, entry: Column, ts: str, within_seconds: int) -> DataFrame:
    """Rows with ``_entry``, cut into time slices (``_in``). A row of the first ``within_seconds`` of a slice is shown to the
    slice before as well (``_own`` is false there), which is all a slice needs to know of the future. So even a single key
    that holds most rows is spread over many tasks. A row without a time is no visit and stays behind."""
    span, micros = within_seconds * 1_000_000, F.unix_micros(ts)
    slice_of = F.floor(micros / F.lit(span * SLICE)).cast("long")
    early = F.pmod(micros, F.lit(span * SLICE)) < span
    marked = df.where(F.col(ts).isNotNull()).withColumn("_entry", F.coalesce(entry, F.lit(False)))
    shown = F.explode(F.when(early, F.array(slice_of, slice_of - 1)).otherwise(F.array(slice_of)))
    return marked.withColumn("_in", shown).withColumn("_own", F.col("_in") == slice_of)


def verdicts(
    df: DataFrame, key: str, entry: Column, ts: str = "rowtime", seq: str = "seq", within_seconds: int = WITHIN_SECONDS
) -> DataFrame:
    """Rows where ``entry`` holds, with the ``kind`` of what follows: ``match`` where the key's next row is another entry within
    the time, ``timeout`` where it comes too late (the exact limit included) or never. Rows with an ordinary follower are
    left out. One pass gives both kinds, on tables and on streams."""
    rows = _sliced(df, entry, ts, within_seconds)
    if df.isStreaming:
        from millrace.streaming.stateful import verdicts_stream

        return verdicts_stream(rows, key, ts, seq, within_seconds, _SLICES)
    order = Window.partitionBy(key, "_in").orderBy(ts, seq)
    seen = rows.withColumn("_next", F.lead(F.struct(F.col(ts).alias("t"), F.col("_entry").alias("e"))).over(order))
    late = F.col("_next").isNull() | (F.unix_micros("_next.t") - F.unix_micros(ts) >= within_seconds * 1_000_000)
    kind = F.when(late, "timeout").when(F.col("_next.e"), "match")
    found = seen.where(F.col("_own") & F.col("_entry")).withColumn("kind", kind)
    return found.where(F.col("kind").isNotNull()).select(*df.columns, "kind")


def bounces(
    df: DataFrame, key: str, entry: Column, ts: str = "rowtime", seq: str = "seq", within_seconds: int = WITHIN_SECONDS
) -> DataFrame:
    """Rows where ``entry`` holds and the key's next row is another entry, comes too late, or never comes."""
    return verdicts(df, key, entry, ts, seq, within_seconds).drop("kind")


def timeouts(
    df: DataFrame, key: str, entry: Column, ts: str = "rowtime", seq: str = "seq", within_seconds: int = WITHIN_SECONDS
) -> DataFrame:
    """Only those bounces whose pattern timed out."""
    return verdicts(df, key, entry, ts, seq, within_seconds).where("kind = 'timeout'").drop("kind")


def next_row(df: DataFrame, key: str, ts: str, seq: str, value: str) -> DataFrame:
    """Value of the key's next row in time order, for keys with a bounded number of rows."""
    return df.withColumn(f"next_{value}", F.lead(value).over(Window.partitionBy(key).orderBy(ts, seq)))
