"""Dimension job: change rows of configured tables into dimension tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.changes import clean_changes
from millrace.operators.routing import route_changes, table_columns
from millrace.sinks.dimensions import DimensionStore, config_rows, merge_columns
from millrace.sources.lookups import latest_config


def routed(changes: DataFrame, config_changes: DataFrame) -> DataFrame:
    return route_changes(clean_changes(changes), latest_config(config_changes))


def dimension_cells(changes: DataFrame, config_changes: DataFrame, seq: str = "seq") -> DataFrame:
    """Current value of every cell of every dimension table: ``sink_table, pk, column, value``.

    One pass serves all tables: rows are spread over (table, key, column) and the latest write of a cell is
    an aggregate, so neither a big table nor a busy key ends up in a single task.
    """
    rows = routed(changes, config_changes)
    key = F.col("data")[F.col("sink_pk")].alias("pk")
    cells = rows.select("sink_table", key, seq, F.explode("data").alias("column", "value"))
    return cells.groupBy("sink_table", "pk", "column").agg(F.max_by("value", seq).alias("value"))


def dimension_table(changes: DataFrame, config_changes: DataFrame, sink_table: str, columns: list[str], pk: str = "id") -> DataFrame:
    """Current rows of one dimension table."""
    return merge_columns(table_columns(routed(changes, config_changes), sink_table, columns), pk, columns, ["seq"])


def upsert_batch(
    load_config: Callable[[SparkSession], DataFrame], folder: str, database: str = "default", ddl: bool = True, every: int = 1
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of the job.

    The configuration is read anew for every micro-batch, so a change counts from the next one on. Rows whose table is not
    configured by then are dropped. All others are written at once; after ``every`` micro-batches the catalog tables are
    brought up to date (with ``ddl``).
    """
    store = DimensionStore(folder)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        config = latest_config(load_config(spark))
        store.write(route_changes(clean_changes(batch), config), batch_id)
        if ddl and (batch_id + 1) % every == 0:
            for entry in config_rows(config):
                store.publish(spark, entry, database)

    return run
