"""From documents to packed training sequences. Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, near_dedup, packing, pseudonyms, quality_rules
from millrace.llm.common import landed, pseudonym_key, read_table, tokenizer_file
from millrace.llm.queries import TRIAL_KEY
from millrace.session import tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned decision list rejects."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, read_table(tune(spark), sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    tune(spark)
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by near-duplicates (five words, 80 %)."""
    tune(spark)
    return near_dedup.deduplicate(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts."""
    return pseudonyms.replace(docs, pseudonym_key(tune(spark), TRIAL_KEY))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    tune(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("pseudonyms", private), ("packing", packed)]

#: The stages learn rules, estimate from registers and pack with a tokenizer: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(tune(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
