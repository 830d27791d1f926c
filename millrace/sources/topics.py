"""Topics as DataFrames: raw text, declared JSON tables, change envelopes, upsert topics.

The Kafka readers only build options; the connector has to be on the cluster's class path. Everything behind
the raw ``value`` column is the same for a topic, for files and for a batch table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace import schemas
from millrace.functions import times
from millrace.functions.values import once

_BROKEN = "_broken"


def kafka_options(topics: str | list[str], servers: str, group: str | None = None, starting: str = "earliest") -> dict:
    """Reader options. Offsets live in the query checkpoint; ``starting`` only counts for the first start."""
    names = [topics] if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_topic(spark: SparkSession, topics: str | list[str], servers: str, streaming: bool = True, **more) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    df = reader.format("kafka").options(**kafka_options(topics, servers, **more)).load()
    return raw_text(df.select("topic", "partition", F.col("offset").alias("seq"), "value"))


def file_topic(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    streaming: bool = True,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A folder that new files keep arriving in. The schema is declared, never inferred."""
    reader = (spark.readStream if streaming else spark.read).schema(schema).format(fmt)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def raw_text(df: DataFrame, value: str = "value") -> DataFrame:
    """Bytes to UTF-8 text; records without a value are discarded."""
    return df.withColumn(value, F.col(value).cast("string")).where(F.col(value).isNotNull())


def parsed(raw: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Raw text beside its parsed record ``_doc``; null ``_doc`` fields and ``_broken`` tell unreadable text."""
    wide = StructType([*schema.fields, StructField(_BROKEN, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    rest = [c for c in raw.columns if c != value]
    return once(raw_text(raw, value), [*rest, value], _doc=F.from_json(value, wide, options))


def unreadable() -> Column:
    return F.col(f"_doc.{_BROKEN}").isNotNull() | F.col("_doc").isNull()


def split_dirty(raw: DataFrame, schema: StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows that parse, with the schema's columns; raw text of the rows that do not)."""
    rows = parsed(raw, schema, value)
    rest = [c for c in raw.columns if c != value]
    good = rows.where(~unreadable()).select(*rest, *[F.col("_doc")[f.name].alias(f.name) for f in schema.fields])
    dirty = rows.where(unreadable()).select(*rest, value)
    return good, dirty


def json_table(raw: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Declared table over a JSON topic; unreadable records are left out."""
    return split_dirty(raw, schema, value)[0]


def cdc_table(raw: DataFrame) -> DataFrame:
    return json_table(raw, schemas.CDC)


def upsert_table(raw: DataFrame, schema: StructType) -> DataFrame:
    """Upsert topic read plainly: tombstones go, every version of a key stays."""
    return json_table(raw, schema)


def with_event_time(df: DataFrame, ts, name: str = "rowtime", delay: str = "3 seconds") -> DataFrame:
    """Computed event-time column; on a stream it also carries the out-of-orderness bound."""
    df = df.withColumn(name, ts)
    return df.withWatermark(name, delay) if df.isStreaming else df


def with_processing_time(df: DataFrame, name: str = "proc_time") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def page_time(df: DataFrame, delay: str = "3 seconds", name: str = "rowtime") -> DataFrame:
    """Event time of a click log (milliseconds)."""
    return with_event_time(df, F.timestamp_millis("ts"), name, delay)


def trade_time(df: DataFrame, delay: str = "3 seconds", name: str = "rowtime") -> DataFrame:
    """Event time of a trade fact (seconds, possibly as text)."""
    return with_event_time(df, times.from_seconds("ts"), name, delay)
