"""Names and attributes from reference tables.

No join here carries a broadcast hint: Spark knows the size of the reference table and broadcasts it when it
is small, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dic: DataFrame, code: str, name: str) -> DataFrame:
    """Add ``name`` for ``code`` from a dictionary; rows whose code is unknown are dropped.

    Several roles of one dictionary are several calls.
    """
    role = dic.select(F.col("dic_code").alias("_code"), F.col("dic_name").alias(name))
    return df.join(role, F.col(code) == F.col("_code"), "inner").drop("_code")


def enrich(df: DataFrame, dim: DataFrame, key: str, columns: dict[str, str], dim_key: str = "id") -> DataFrame:
    """Add dimension attributes ``{source: target}``; rows without a match stay, with nulls."""
    side = dim.select(F.col(dim_key).alias("_dim_key"), *[F.col(s).alias(t) for s, t in columns.items()])
    return df.join(side, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def flatten_sku(dims: dict[str, DataFrame]) -> DataFrame:
    """Product with trademark, unit and three category levels: one row per product.

    Built once from the dimensions, so facts need a single join however long the chain is.
    """
    sku = dims["dim_sku_info"].select(F.col("id").alias("sku_id"), "sku_name", F.col("tm_id").alias("trademark_id"), F.col("category3_id"), "spu_id")
    steps = [
        ("dim_base_trademark", "trademark_id", {"tm_name": "trademark_name"}),
        ("dim_spu_info", "spu_id", {"spu_name": "spu_name"}),
        ("dim_base_category3", "category3_id", {"name": "category3_name", "category2_id": "category2_id"}),
        ("dim_base_category2", "category2_id", {"name": "category2_name", "category1_id": "category1_id"}),
        ("dim_base_category1", "category1_id", {"name": "category1_name"}),
    ]
    for name, key, columns in steps:
        sku = enrich(sku, dims[name], key, columns)
    return sku
