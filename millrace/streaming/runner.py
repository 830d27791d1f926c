"""Start streams into versioned folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: time between two flushes of a summary sink.
FLUSH = "3 seconds"


def start(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    once: bool = False,
    every: str = FLUSH,
) -> StreamingQuery:
    """Run ``write(batch, batch_id)`` for every micro-batch; ``once`` stops when the present input is used up."""
    writer = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def run_once(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    query = start(df, write, checkpoint, mode, once=True)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their window had closed and were dropped."""
    operators = [op for p in query.recentProgress for op in (p.get("stateOperators") or [])]
    return sum(op.get("numRowsDroppedByWatermark", 0) for op in operators)


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Rows and bytes held in state at the end of the last micro-batch."""
    last = query.lastProgress or {}
    operators = last.get("stateOperators") or []
    return {
        "rows": sum(op.get("numRowsTotal", 0) for op in operators),
        "bytes": sum(op.get("memoryUsedBytes", 0) for op in operators),
    }
