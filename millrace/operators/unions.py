"""Inputs of one schema, side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*parts: DataFrame) -> DataFrame:
    """Tables or streams together, by column name; of several streams the slowest watermark counts."""
    return reduce(DataFrame.unionByName, parts)


def measures(df: DataFrame, dims: list[Column | str], names: list[str], given: dict[str, Column | int]) -> DataFrame:
    """Dimension columns plus one column per measure: the given ones, and zero for all others."""
    values = [given.get(n, 0) for n in names]
    columns = [(v if isinstance(v, Column) else F.lit(v)).cast("long").alias(n) for n, v in zip(names, values)]
    return df.select(*dims, *columns)
