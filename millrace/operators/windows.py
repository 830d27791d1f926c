"""Tumbling windows, shared by batch tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import times

# Fixed value: length of the summary windows.
LENGTH = "10 seconds"


def decorate(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Window bounds as text, and the version ``ts`` of the row."""
    return (
        df.withColumn("stt", times.second("window.start"))
        .withColumn("edt", times.second("window.end"))
        .withColumn("ts", times.now_millis(now))
        .drop("window")
    )


def tumble(
    df: DataFrame,
    aggs: list[Column],
    keys: list[str] | None = None,
    length: str = LENGTH,
    ts: str = "rowtime",
    now: Column | None = None,
) -> DataFrame:
    """Aggregates per window and key. Without keys the window is global, still with partial sums per task."""
    return decorate(df.groupBy(F.window(ts, length), *(keys or [])).agg(*aggs), now)


def sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def per_member(
    df: DataFrame, keys: list[str], member: str, measures: list[str], length: str = LENGTH, ts: str = "rowtime"
) -> DataFrame:
    """Sums per window, key and member: the inner level of an exact distinct count."""
    aggs = sums(*measures) or [F.count(F.lit(1)).alias("_rows")]
    return df.groupBy(F.window(ts, length), *keys, member).agg(*aggs)


def tumble_distinct(
    df: DataFrame,
    keys: list[str],
    member: str,
    count: str,
    measures: list[str],
    length: str = LENGTH,
    ts: str = "rowtime",
    now: Column | None = None,
) -> DataFrame:
    """Sums and the exact number of distinct members per window and key.

    The inner level spreads a hot key over its members; the outer one only adds up one row per member. The
    same two levels run on a stream, where a plain distinct count is refused.
    """
    inner = per_member(df, keys, member, measures, length, ts)
    outer = F.window(F.window_time("window"), length) if df.isStreaming else F.col("window")
    total = inner.groupBy(outer.alias("window"), *keys).agg(F.count(F.lit(1)).alias(count), *sums(*measures))
    return decorate(total, now)


def buffered(
    df: DataFrame, columns: list[str], order: list[str], keys: list[str], length: str = LENGTH, ts: str = "rowtime"
) -> DataFrame:
    """All rows of a window and key as an ordered array ``rows``, for logic that has no incremental form.

    The logic follows as higher-order functions over the array. The array is as long as the key has rows in
    one window, so use ``tumble`` wherever a sum or a count will do.
    """
    item = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *columns)
    rows = df.groupBy(F.window(ts, length), *keys).agg(F.array_sort(F.collect_list(item)).alias("rows"))
    return rows.withColumn("stt", times.second("window.start")).withColumn("edt", times.second("window.end")).drop("window")


def behind_watermark(df: DataFrame, ts: str, arrival: list[str], delay_seconds: int, number: str, parts: int = 200) -> DataFrame:
    """Rows with ``late``: whether they lie more than ``delay_seconds`` behind the largest time that arrived before them.

    The table's twin of a stream's watermark that moves with every row. Rows are cut into ``parts`` ranges of ``number``, the
    first of the columns ``arrival``; a range takes over the largest time of those before it and then looks at its own rows
    in order, so no task sees more than a range.
    """
    low, high = df.agg(F.min(number), F.max(number)).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // parts))
    ranged = df.withColumn("_range", F.floor((F.col(number) - (low or 0)) / width).cast("long"))
    tops = ranged.groupBy("_range").agg(F.max(ts).alias("_top"))
    # as many rows as ranges
    before = tops.select(F.col("_range"), F.max("_top").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    own = Window.partitionBy("_range").orderBy(*arrival).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ranged.withColumn("_own", F.max(ts).over(own)).join(before, "_range", "left")
    top = F.greatest("_own", "_before")
    return seen.withColumn("late", F.coalesce(F.unix_micros(ts) < F.unix_micros(top) - delay_seconds * 1_000_000, F.lit(False))).drop("_range", "_own", "_before")
