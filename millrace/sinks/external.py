"""Rows for topics and JDBC tables. The connectors have to be on the cluster's class path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sinks.tables import run_id

#: Rows sent to a JDBC table at once.
BATCH_ROWS = 1000


def json_value(df: DataFrame) -> DataFrame:
    """Whole rows as JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def upsert_messages(df: DataFrame, keys: list[str], topic: str | None = None) -> DataFrame:
    """Key and value as JSON, for a topic whose readers keep the latest value per key."""
    out = df.select(F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    return out.select(F.lit(topic).alias("topic"), "key", "value") if topic else out


def kafka_sink_options(servers: str, topic: str | None = None) -> dict:
    """Writer options; without ``topic`` every row names its own in a ``topic`` column.

    Spark writes to topics at least once. Readers remove repeats by key.
    """
    options = {"kafka.bootstrap.servers": servers}
    if topic:
        options["topic"] = topic
    return options


def write_topic(messages: DataFrame, checkpoint: str, servers: str, topic: str | None = None):
    """Start a stream of messages into topics."""
    writer = messages.writeStream.format("kafka").options(**kafka_sink_options(servers, topic))
    return writer.option("checkpointLocation", checkpoint).start()


def jdbc_sink_options(url: str, table: str, driver: str, batch_rows: int = BATCH_ROWS) -> dict:
    return {"url": url, "dbtable": table, "driver": driver, "batchsize": str(batch_rows)}


def jdbc_append(columns: list[str], marked: bool = False, **connection) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends the declared columns, in declared order, to a JDBC table.

    A micro-batch that is run again after a failure appends its rows again. With ``marked`` each row also carries ``run`` (the
    query, as its checkpoint names it) and ``batch_id``, by which readers, or a unique index over them and the key, tell repeats.
    """
    options = jdbc_sink_options(**connection)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns)
        if marked:
            rows = rows.withColumns({"run": F.lit(run_id(batch)), "batch_id": F.lit(batch_id).cast("long")})
        rows.write.format("jdbc").mode("append").options(**options).save()

    return run
