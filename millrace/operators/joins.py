"""Joins of two change streams within a bounded time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.streaming import stateful

# How long a row waits for its partner, in seconds.
ORDER_WAIT = 905
REFUND_WAIT = 5


def bounded_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    wait_seconds: int | None,
    how: str = "inner",
    ts: str = "event_time",
    alone: bool = False,
) -> DataFrame:
    """Equi-join of ``left`` and ``right`` on ``{left column: right column}``, at most ``wait_seconds`` apart.

    Both sides carry ``ts``, with a watermark if they are streams. The bound then evicts join state and
    releases the unmatched rows of a left outer join; a table keeps the same meaning. ``None`` sets no bound,
    which is for tables only: a stream's caller has to choose one. The right side's keys and time are left out
    of the result.

    ``alone`` says that no other stateful operator follows in a stream's query. An inner join then keeps its state by buckets of
    keys, which costs far less than one of single rows; ``ts`` of its result has no watermark.
    """
    if wait_seconds is None and (left.isStreaming or right.isStreaming):
        raise ValueError("a join of streams needs a bound on how long rows wait")
    if alone and how == "inner" and left.isStreaming and right.isStreaming and stateful.can_join_in_buckets(left, right, on, ts):
        return stateful.bounded_join_stream(left, right, on, wait_seconds, ts)
    renamed = {ts: "_right_ts", **{r: f"_right_{i}" for i, r in enumerate(on.values())}}
    keep = [F.col(c).alias(renamed.get(c, c)) for c in right.columns]
    other = right.select(*keep)
    match = [F.col(name) == F.col(renamed[r]) for name, r in on.items()]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    if wait_seconds is not None:
        wait = F.expr(f"INTERVAL {wait_seconds} SECONDS")
        condition = condition & (F.col("_right_ts") >= F.col(ts) - wait) & (F.col("_right_ts") <= F.col(ts) + wait)
    return left.join(other, condition, how).drop(*renamed.values())


def beside(rows: DataFrame, extra: DataFrame, key: str, extra_key: str, place: str, name: str) -> DataFrame:
    """``extra`` with the ``place`` of the ``rows`` of its key as ``name``, so that it can be dealt out to where they lie.

    For tables. A narrow ``extra`` then joins by key and place to wide rows that are dealt out by place, and the wide rows stay
    where they are (see ``session.RUNTIME_CONF``). A key with rows in several places is in each of them once; one without rows
    is left out.
    """
    places = rows.select(F.col(key).alias("_key"), F.col(place).alias(name)).distinct()
    return extra.join(places, F.col(extra_key) == F.col("_key")).drop("_key")
