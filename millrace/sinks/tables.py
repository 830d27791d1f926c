"""Summary and fact tables as parquet folders that micro-batches append to."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators.dedup import latest_row
from millrace.schemas import SUMMARY_COLUMNS, SUMMARY_KEYS, summary_types


def by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Bind columns to the sink by position, as ``insert into … select *`` does."""
    if len(df.columns) != len(names):
        raise ValueError(f"sink has {len(names)} columns, query has {len(df.columns)}")
    return df.toDF(*names)


def sink_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Declared columns in declared order; helper columns stay behind."""
    return df.select(*names)


def with_day(df: DataFrame, stt: str = "stt") -> DataFrame:
    """Day partition of the window start, such as 20220917."""
    return df.withColumn("dt", times.day_number(F.to_timestamp(stt)))


#: Partition columns below the day: the query that wrote a row and its micro-batch. They also tell which of two equal versions
#: came later.
ARRIVAL = ["batch_id", "run"]


def latest(df: DataFrame, keys: list[str], version: str = "ts") -> DataFrame:
    """Replacing read: of the rows with equal sort key only the largest version counts.

    Of equal versions the later arrival counts, where ``df`` has the columns that tell, else the row with the larger values.
    """
    arrival = [c for c in ARRIVAL if c in df.columns] or sorted(c for c in df.columns if c not in keys and c != version)
    return latest_row(df, keys, [version, *arrival])


def run_id(batch: DataFrame) -> str:
    """The query that runs this micro-batch, by the id that its checkpoint keeps over restarts; ``batch`` for a plain write."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def read_folder(spark: SparkSession, path: str, schema: str | None, kind: str = "parquet") -> DataFrame:
    """A folder of files. With a declared ``schema`` one that has none, or isn't there yet, has no rows."""
    if schema is None:
        return spark.read.format(kind).load(path)
    try:
        return spark.read.format(kind).schema(schema).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class VersionedTable:
    """Append-only folder of summary rows by day, read through ``latest``.

    Below the day lie the query and the micro-batch that wrote the rows: a micro-batch that is written again replaces its own
    rows of each day, so a restart adds nothing twice, and another query never replaces them. ``types`` (as in a schema
    string) declares the columns; without it a table that has no rows can't be read.
    """

    def __init__(self, path: str, keys: list[str], columns: list[str], version: str = "ts", types: str | None = None):
        self.path, self.keys, self.columns, self.version = path.rstrip("/"), keys, columns, version
        self.schema = f"{types}, dt int, run string, batch_id long" if types else None

    @classmethod
    def summary(cls, path: str, name: str) -> VersionedTable:
        """A summary by its declared name."""
        return cls(path, SUMMARY_KEYS[name], SUMMARY_COLUMNS[name], types=summary_types(name))

    def append(self, batch: DataFrame, batch_id: int = 0) -> None:
        rows = with_day(sink_columns(batch, self.columns))
        rows = rows.withColumns({"run": F.lit(run_id(batch)), "batch_id": F.lit(batch_id).cast("long")})
        # a day's rows in few files: small days together in one task, a large one in several
        rows = rows.hint("rebalance", "dt").sortWithinPartitions("dt", *self.keys)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("dt", "run", "batch_id").parquet(self.path)

    def versions(self, spark: SparkSession) -> DataFrame:
        """All versions, with the partition columns ``dt``, ``run`` and ``batch_id``."""
        return read_folder(spark, self.path, self.schema)

    def read(self, spark: SparkSession, day: int | None = None) -> DataFrame:
        """Current rows. The day is the outer partition, so a read of one day lists and scans that day alone."""
        rows = self.versions(spark)
        if day is not None:
            rows = rows.where(F.col("dt") == day)
        return latest(rows, self.keys, self.version)

    def compact(self, spark: SparkSession, path: str) -> VersionedTable:
        """The current rows as a table of their own in a new folder."""
        into = VersionedTable(path, self.keys, self.columns, self.version)
        into.schema = self.schema
        into.append(self.read(spark))
        return into


class FactTable:
    """Append-only folder of fact rows, again one sub-folder per query and micro-batch."""

    def __init__(self, path: str, columns: list[str] | None = None):
        self.path, self.columns = path.rstrip("/"), columns

    def append(self, batch: DataFrame, batch_id: int = 0) -> None:
        rows = sink_columns(batch, self.columns) if self.columns else batch
        rows.write.mode("overwrite").parquet(f"{self.path}/run={run_id(batch)}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("run", "batch_id")
