"""First visits: unique visitors, repaired new-visitor flags, logins and returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.functions.values import flag
from millrace.operators.dedup import first_row

# Fixed value: a user is back when the last login lies at least this many days before.
RETURN_DAYS = 8


def first_per_day(
    df: DataFrame, key: str, ts: str = "rowtime", seq: str = "seq", also: list[str] | None = None, clock: str = "EventTime"
) -> DataFrame:
    """The first row of every key and day. ``also`` adds columns to the key (such as the page).

    On a stream ``clock`` says what ends a day's state: the watermark, which also drops late rows, or ``ProcessingTime``, the
    time of the machine, which drops none.
    """
    keys = [key, *(also or [])]
    if df.isStreaming:
        from millrace.streaming.stateful import first_per_day_stream

        return first_per_day_stream(df, keys, ts, seq, clock)
    return first_row(df.withColumn("_day", times.day(ts)), [*keys, "_day"], [ts, seq]).drop("_day")


def first_time_per_day(df: DataFrame, keys: list[str], ts: str = "rowtime") -> DataFrame:
    """Only the time of the first row of every key and day: a hash aggregate over one fixed-width value."""
    return df.groupBy(*keys, times.day(ts).alias("day")).agg(F.min(ts).alias(ts))


def repair_new_visitor(
    df: DataFrame, key: str, is_new: str, ts: str = "rowtime", seq: str = "seq", out: str = "is_new"
) -> DataFrame:
    """Add ``out``: the new-visitor flag, corrected by the first visit of the key.

    The first record fixes a date for good: its own day if it says "new", the day before otherwise. A later
    "new" on any other day becomes ``'0'``. Everything else stays as it is, rows without a time included.

    Only a "new" record with a time can change, so the others pass straight through. On tables the rest joins one narrow row
    per visitor, and only visitors with such a record; keys that hold many rows are left to the engine's skew split. ``df``
    is read once for the dates and once for either kind of row: hand a costly one over as a table first. On a stream it is
    read once for each kind.
    """
    flagged = df.withColumn("_is_new", F.col(is_new)).withColumn("_key", F.col(key))
    day, says_new = times.day(ts), F.col("_is_new") == "1"
    may_change = F.coalesce(says_new & F.col(ts).isNotNull(), F.lit(False))
    if df.isStreaming:
        from millrace.streaming.stateful import repair_new_visitor_stream

        return repair_new_visitor_stream(flagged, ts, seq, out, may_change)
    origin = F.when(says_new, day).otherwise(times.day_before(ts))
    dated = flagged.where(F.col(ts).isNotNull()).groupBy(F.col("_key").alias("_visitor"))
    per_key = dated.agg(F.min_by(origin, F.struct(ts, seq)).alias("_origin"), F.max(may_change).alias("_asks")).where("_asks").drop("_asks")
    asked = flagged.where(may_change).join(per_key, F.col("_key").eqNullSafe(F.col("_visitor")), "left")
    asked = asked.withColumn(out, F.when(day != F.col("_origin"), "0").otherwise(F.col("_is_new")))
    passed = flagged.where(~may_change).withColumn(out, F.col("_is_new"))
    return passed.drop("_key", "_is_new").unionByName(asked.drop("_key", "_visitor", "_origin", "_is_new"))


def login_days(df: DataFrame, key: str, ts: str = "rowtime", min_days: int = RETURN_DAYS) -> DataFrame:
    """One row per user and login day with ``uu_ct`` = 1 and ``back_ct`` = 1 on a return after a long break.

    A row without a time has no day and is left out. The rows are reduced to one per user and day first, so the ordered
    window over a user has at most as many rows as there are days.
    """
    if df.isStreaming:
        from millrace.streaming.stateful import login_days_stream

        return login_days_stream(df, key, ts, min_days)
    days = first_time_per_day(df.where(F.col(ts).isNotNull()), [key], ts)
    last = F.lag("day").over(Window.partitionBy(key).orderBy("day"))
    back = flag(times.days_since(ts, last) >= min_days)
    return days.select(key, ts, F.lit(1).cast("long").alias("uu_ct"), back.alias("back_ct"))
