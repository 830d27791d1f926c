"""Time expressions. Every one of them follows the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the warehouse.
DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
PARTITION_FORMAT = "yyyyMMdd"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def from_millis(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms).cast("long"))


def from_millis_to_second(ms: Column | str) -> Column:
    """Millisecond epoch to a timestamp that is cut off to whole seconds."""
    return F.timestamp_seconds(F.floor(_col(ms).cast("long") / F.lit(1000)))


def from_seconds(seconds: Column | str) -> Column:
    """Second epoch, possibly as text, to a timestamp."""
    return F.timestamp_seconds(_col(seconds).try_cast("long"))


def day(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DAY_FORMAT)


def day_before(ts: Column | str) -> Column:
    return F.date_format(F.date_sub(F.to_date(_col(ts)), 1), DAY_FORMAT)


def second(ts: Column | str) -> Column:
    return F.date_format(_col(ts), SECOND_FORMAT)


def day_number(ts: Column | str) -> Column:
    """Day as an integer such as 20220917."""
    return F.date_format(_col(ts), PARTITION_FORMAT).cast("int")


def days_since(ts: Column | str, earlier_day: Column | str) -> Column:
    """Whole days between the midnight of ``earlier_day`` (text) and ``ts``."""
    return F.datediff(F.to_date(_col(ts)), F.to_date(_col(earlier_day), DAY_FORMAT))


def version_time(text: Column | str) -> Column:
    """Version text such as ``2022-09-14 02:05:30.08Z``, compared as time rather than as text."""
    return F.try_to_timestamp(_col(text))


def now_millis(now: Column | None = None) -> Column:
    """Wall clock in milliseconds, or a given stand-in that makes runs repeatable."""
    return now if now is not None else F.unix_millis(F.current_timestamp())


def now(value: Column | None = None) -> Column:
    return value if value is not None else F.current_timestamp()
