"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words everywhere in this subpackage: space and the control characters from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"


def shared_folder(spark: SparkSession, own: str | None = None) -> str:
    """A fresh folder that the driver and all executors see.

    The cluster names its root in ``spark.checkpoint.dir``. Where that is unset, ``own`` has to be given; a folder of
    this machine alone is never chosen silently.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or own
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def landed(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later stages don't depend on executors that held it."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        n = name
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once a row however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def in_batches_of(spark: SparkSession, rows: int, most_bytes: int | None = None) -> None:
    """Bound the Arrow batches sent to Python: whole texts can be long. ``most_bytes`` takes effect from Spark 4.1 on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if most_bytes:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns most operators need, under fixed names, whatever else ``docs`` carries; a null text becomes empty."""
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def tokenizer_file(name: str) -> str:
    """Where the installed package of public tokenizers has ``name``; every operator takes such a path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pseudonym_key(spark: SparkSession, trial: str | None = None) -> str:
    """The secret of the pseudonyms, from ``spark.millrace.pseudonym.key``. Where that is unset, the caller has to name a key
    for trials; whoever knows it can undo the pseudonyms, so none is chosen silently."""
    key = spark.conf.get("spark.millrace.pseudonym.key", None) or trial
    if not key:
        raise ValueError("set spark.millrace.pseudonym.key to a secret")
    return key
