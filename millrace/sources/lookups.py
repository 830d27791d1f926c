"""Small reference tables that facts look names up in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dictionary codes and the names they stand for in tests and examples.
DICTIONARY = [
    ("1101", "alipay"),
    ("1102", "wechat"),
    ("1103", "unionpay"),
    ("1301", "quality"),
    ("1302", "description"),
    ("1303", "out of stock"),
    ("1304", "number"),
    ("1305", "wrong order"),
    ("1306", "unwanted"),
    ("1307", "other"),
    ("1501", "refund only"),
    ("1502", "return and refund"),
    ("2401", "search"),
    ("2402", "promotion"),
    ("2403", "recommendation"),
]


def literal_table(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """Rows as a literal relation, whose exact size the planner knows (unlike that of a local collection)."""
    shown = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "\\'") + "'"
    values = ", ".join(f"({', '.join(map(shown, row))})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def dictionary(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DICTIONARY, "dic_code, dic_name")


def jdbc_options(url: str, table: str, user: str, password: str, driver: str = "com.mysql.cj.jdbc.Driver") -> dict:
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def jdbc_lookup(spark: SparkSession, columns: list[str], **connection: str) -> DataFrame:
    """The table as it is: the planner measures it when it is joined and then chooses how."""
    return spark.read.format("jdbc").options(**jdbc_options(**connection)).load().select(*columns)


def per_batch(load: Callable[[SparkSession], DataFrame], use: Callable[[DataFrame, DataFrame, int], None]):
    """``foreachBatch`` function that reads the reference table anew for every micro-batch.

    A change of the reference table therefore counts from the next micro-batch on, and no row of it is
    ever older than one trigger interval.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        use(batch, load(batch.sparkSession), batch_id)

    return run


def point_lookup(dim: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of a dimension for a set of keys; the key may be made of several columns."""
    return keys.join(dim, keys.columns, "left")


def latest_config(changes: DataFrame, seq: str = "seq") -> DataFrame:
    """Configuration in force after a stream of c/r/u/d changes: one row per source table.

    Created, read and updated rows put their ``after`` image, a deletion takes the entry away.
    """
    entry = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    last = changes.select(entry["source_table"].alias("source_table"), F.struct("op", "after").alias("change"), seq)
    last = last.groupBy("source_table").agg(F.max_by("change", seq).alias("change"))
    after = F.col("change.after")
    return last.where(F.col("change.op") != "d").select(
        "source_table",
        after["sink_table"].alias("sink_table"),
        after["sink_columns"].alias("sink_columns"),
        F.coalesce(after["sink_pk"], F.lit("id")).alias("sink_pk"),
        F.coalesce(after["sink_extended"], F.lit("")).alias("sink_extended"),
    )
