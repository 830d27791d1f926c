"""Connected components of an edge table, by repeatedly moving edges to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import landed


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``): each node of ``edges`` (columns a, b) with the smallest node it is connected to.

    Every round replaces each edge by one to the smallest member of a neighbourhood, which keeps what is connected and ends
    with a star around each smallest node. Rounds are written to the shared folder; only counts come to the driver.
    """
    edges = landed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
        moved = both.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("label").alias("b"))
        edges = landed(moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
