"""One input, several outputs: click-log records to topics, change rows to dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Topics of the split click log.
DIRTY_TOPIC = "dirty_data"
ERR_TOPIC = "dwd_traffic_err_log"
START_TOPIC = "dwd_traffic_start_log"
DISPLAY_TOPIC = "dwd_traffic_display_log"
ACTION_TOPIC = "dwd_traffic_action_log"
PAGE_TOPIC = "dwd_traffic_page_log"


def error_rows(log: DataFrame) -> DataFrame:
    """Whole records that carry an error."""
    return log.where(F.col("err").isNotNull())


def start_rows(log: DataFrame) -> DataFrame:
    return log.where(F.col("start").isNotNull()).drop("err")


def _pages(log: DataFrame) -> DataFrame:
    return log.where(F.col("start").isNull())


def page_rows(log: DataFrame) -> DataFrame:
    return _pages(log).drop("err", "start", "displays", "actions")


def display_rows(log: DataFrame) -> DataFrame:
    """One row per display with its page, visitor and time; no displays, no rows."""
    keep = [c for c in log.columns if c not in ("err", "start", "displays", "actions")]
    return _pages(log).select(*keep, F.explode("displays").alias("display"))


def action_rows(log: DataFrame) -> DataFrame:
    keep = [c for c in log.columns if c not in ("err", "start", "displays", "actions")]
    return _pages(log).select(*keep, F.explode("actions").alias("action"))


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """The five typed outputs of the click log, by topic."""
    return {
        ERR_TOPIC: error_rows(log),
        START_TOPIC: start_rows(log),
        DISPLAY_TOPIC: display_rows(log),
        ACTION_TOPIC: action_rows(log),
        PAGE_TOPIC: page_rows(log),
    }


def route_log(log: DataFrame, keep: list[str] | None = None, dirty: Column | None = None) -> DataFrame:
    """All outputs of the click log as ``topic, value`` rows in a single pass over the input.

    The rows of a record are built side by side and exploded, so the input is parsed once for five topics.
    ``keep`` names columns of the record that travel beside its messages. ``dirty`` is the text of a record
    that could not be read, and null for all others.
    """
    unread = dirty if dirty is not None else F.lit(None).cast("string")

    def message(topic: str, *columns: Column | str) -> Column:
        return F.struct(F.lit(topic).alias("topic"), F.to_json(F.struct(*columns)).alias("value"))

    def when(condition: Column, messages: Column) -> Column:
        return F.when(condition, messages).otherwise(F.array().cast("array<struct<topic:string,value:string>>"))

    def each(items: str, topic: str, name: str) -> Column:
        return F.transform(F.col(items), lambda item: message(topic, "page", "common", "ts", item.alias(name)))

    is_page = F.col("start").isNull() & unread.isNull()
    messages = F.concat(
        when(unread.isNotNull(), F.array(F.struct(F.lit(DIRTY_TOPIC).alias("topic"), unread.alias("value")))),
        when(
            F.col("err").isNotNull(),
            F.array(message(ERR_TOPIC, "common", "page", "start", "err", "displays", "actions", "ts")),
        ),
        when(F.col("start").isNotNull(), F.array(message(START_TOPIC, "common", "page", "start", "displays", "actions", "ts"))),
        when(is_page & F.col("displays").isNotNull(), each("displays", DISPLAY_TOPIC, "display")),
        when(is_page & F.col("actions").isNotNull(), each("actions", ACTION_TOPIC, "action")),
        when(is_page, F.array(message(PAGE_TOPIC, "page", "common", "ts"))),
    )
    kept = keep or []
    return log.select(*kept, F.explode(messages).alias("m")).select(*kept, "m.topic", "m.value")


def route_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change rows of configured tables, cut down to the configured columns.

    ``sink_table``, ``sink_pk`` and ``type`` travel beside the data. Tables without configuration, including
    those configured only later, are dropped.
    """
    wanted = F.split("sink_columns", ",")
    kept = F.map_filter("data", lambda k, _: F.array_contains(F.col("_wanted"), k))
    match = F.col("table") == F.col("source_table")
    return (
        changes.join(config, match, "inner")
        .withColumn("_wanted", wanted)
        .withColumn("data", kept)
        .drop("_wanted", "source_table", "sink_columns", "sink_extended", "table")
    )


def table_columns(routed: DataFrame, sink_table: str, columns: list[str]) -> DataFrame:
    """Rows of one dimension table with its columns as text; the metadata is left out again."""
    rows = routed.where(F.col("sink_table") == sink_table)
    rest = [c for c in routed.columns if c not in ("data", "type", "sink_table", "sink_pk")]
    return rows.select(*rest, *[F.col("data")[c].alias(c) for c in columns], F.map_keys("data").alias("_supplied"))
