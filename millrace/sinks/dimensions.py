"""Dimension tables: created from configuration, upserted column by column."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.sinks.tables import read_folder, run_id


def create_statement(config: Row, database: str = "default", location: str | None = None) -> str:
    """DDL of a configured table: text columns, key and extension as table properties."""
    columns = ", ".join(f"`{c}` STRING" for c in config["sink_columns"].split(","))
    props = {"sink_pk": config["sink_pk"] or "id", "sink_extended": config["sink_extended"] or ""}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
    place = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {database}.{config['sink_table']} ({columns}) USING parquet TBLPROPERTIES ({listed}){place}"


def config_rows(config: DataFrame) -> list[Row]:
    """Configuration on the driver, which creates a table for each of its rows."""
    return config.collect()


def merge_columns(rows: DataFrame, pk: str, columns: list[str], order: list[str | Column], supplied: str = "_supplied") -> DataFrame:
    """Last write wins per key and column; a write leaves the columns it does not supply as they were.

    A deletion is a write like any other: dimension rows are never removed.
    """
    at = F.struct(*order)
    values = [
        F.max_by(F.col(c), F.when(F.array_contains(supplied, c), at)).alias(c) for c in columns if c != pk
    ]
    merged = rows.groupBy(pk).agg(*(values or [F.count(F.lit(1)).alias("_n")]))
    return merged.select(*columns)


_WRITES = "pk string, data map<string,string>, seq long, run string, batch_id long, sink_table string"


class DimensionStore:
    """Dimension tables in one folder: the writes of every micro-batch, and for each table a snapshot that a pointer names.

    All tables of a micro-batch are written at once, by query and micro-batch, so a restart adds nothing twice. A read takes the
    snapshot and only the writes that came after it. A new snapshot lies in a folder of its own; then its pointer replaces the
    old one in one step, so a reader sees one or the other. Former snapshots stay for those who still read them.
    """

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def write(self, routed: DataFrame, batch_id: int = 0) -> None:
        """Rows as ``routing.route_changes`` gives them, with ``seq``."""
        rows = routed.select(F.col("data")[F.col("sink_pk")].alias("pk"), "data", F.col("seq").cast("long").alias("seq"), "sink_table")
        rows.write.mode("overwrite").partitionBy("sink_table").parquet(f"{self.folder}/writes/run={run_id(routed)}/batch_id={batch_id}")

    def _pointer(self, spark: SparkSession, name: str) -> dict | None:
        found = read_folder(spark, f"{self.folder}/tables/{name}/current.json", "value string", "text").first()
        return json.loads(found["value"]) if found else None

    def _pending(self, spark: SparkSession, name: str, pointer: dict | None) -> DataFrame:
        """Writes that the snapshot doesn't have; both conditions are on partition columns."""
        rows = read_folder(spark, f"{self.folder}/writes", _WRITES).where(F.col("sink_table") == name)
        for run, last in (pointer or {"upto": {}})["upto"].items():
            rows = rows.where((F.col("run") != run) | (F.col("batch_id") > last))
        return rows

    def _rows(self, spark: SparkSession, name: str, pk: str, columns: list[str], pointer: dict | None, pending: DataFrame) -> DataFrame:
        values = [F.col("pk").alias(pk), *[F.col("data")[c].alias(c) for c in columns if c != pk]]
        rows = pending.select(*values, F.map_keys("data").alias("_supplied"), "batch_id", "seq", "run")
        if pointer:
            kept = [c for c in columns if c in pointer["columns"]]
            schema = ", ".join(f"`{c}` string" for c in pointer["columns"])
            base = read_folder(spark, pointer["base"], schema).select(*kept)
            first = [F.array(*map(F.lit, kept)).alias("_supplied"), F.lit(-1).cast("long").alias("batch_id"), F.lit(-1).cast("long").alias("seq"), F.lit("").alias("run")]
            rows = rows.unionByName(base.select("*", *first), allowMissingColumns=True)
        return merge_columns(rows, pk, columns, ["batch_id", "seq", "run"])

    def read(self, spark: SparkSession, name: str, pk: str, columns: list[str]) -> DataFrame:
        """The current rows; reading again in the next micro-batch sees the writes made until then."""
        pointer = self._pointer(spark, name)
        return self._rows(spark, name, pk, columns, pointer, self._pending(spark, name, pointer))

    def snapshot(self, spark: SparkSession, name: str, pk: str, columns: list[str]) -> str:
        """Write the current rows, let the pointer name them and return their folder. Without new writes or columns nothing
        is written."""
        pointer = self._pointer(spark, name)
        pending = self._pending(spark, name, pointer)
        # as many rows as queries have written the table
        newest = {r["run"]: r["last"] for r in pending.groupBy("run").agg(F.max("batch_id").alias("last")).collect()}
        if pointer and not newest and pointer["columns"] == columns:
            return pointer["base"]
        seen = pending.where(F.col("run").isin(list(newest)) if newest else F.lit(False))
        for run, last in newest.items():
            seen = seen.where((F.col("run") != run) | (F.col("batch_id") <= last))
        base = f"{self.folder}/tables/{name}/{uuid.uuid4().hex}"
        self._rows(spark, name, pk, columns, pointer, seen).write.parquet(base)
        upto = {**(pointer or {"upto": {}})["upto"], **newest}
        replace_text(spark, f"{self.folder}/tables/{name}/current.json", json.dumps({"base": base, "columns": columns, "upto": upto}))
        return base

    def publish(self, spark: SparkSession, config: Row, database: str = "default") -> None:
        """Let the catalog table of a configuration have the current rows: it is created where it is missing, and its place
        is the newest snapshot. A table of that name that lies elsewhere is not touched."""
        columns, name = config["sink_columns"].split(","), f"{database}.{config['sink_table']}"
        base = self.snapshot(spark, config["sink_table"], config["sink_pk"] or "id", columns)
        if spark.catalog.tableExists(name):
            place = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location")
            if "/tables/" + config["sink_table"] + "/" not in place:
                raise ValueError(f"{name} is a table of someone else, at {place}")
            if spark.table(name).columns != columns:
                spark.sql(f"DROP TABLE {name}")  # its files stay
        spark.sql(create_statement(config, database, base))
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{base}'")
        spark.catalog.refreshTable(name)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers find the former or the new content, never a part of it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fresh = hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    files = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fresh, target, overwrite)
