"""Keyword tokens, as a column, a SQL table function and cut by a dictionary of any size."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Fixed value: a keyword is a run of letters and digits.
WORD_PATTERN = r"[\p{L}\p{N}]+"


def words(text: Column | str) -> Column:
    """Lower-cased keywords of a text, in order, repeats kept. Runs inside the JVM."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(col), F.lit(WORD_PATTERN), F.lit(0))


def register(spark: SparkSession) -> None:
    """Register ``tokenize(text)`` as a table function for ``LATERAL tokenize(...)`` in SQL."""
    pattern = WORD_PATTERN.replace("\\", "\\\\")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION tokenize(text STRING) RETURNS TABLE (word STRING) "
        f"RETURN SELECT explode(regexp_extract_all(lower(text), '{pattern}', 0)) AS word"
    )


def segmented(rows: DataFrame, text: Column, dictionary: DataFrame, column: str = "word", name: str = "words") -> DataFrame:
    """``rows`` with the array ``name``: the runs of ``text`` cut by the longest dictionary word at each position.

    Takes the longest dictionary word at each position, for a dictionary of any size: all parts of each distinct text are joined with the words.
    A null text gives null.
    """
    known = dictionary.select(F.lower(column).alias("_part")).where(F.length("_part") > 1).distinct()
    longest = known.agg(F.coalesce(F.max(F.length("_part")), F.lit(1)).alias("_longest"))
    keyed = rows.withColumn("_text", text).withColumn("_key", F.sha2(F.col("_text"), 256))
    texts = keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.any_value("_text").alias("_text"))
    runs = texts.select("_key", words("_text").alias("_runs"))

    each = runs.select("_key", F.posexplode("_runs").alias("_run", "_word")).join(longest)  # a single row
    starts = each.select("*", F.explode(F.sequence(F.lit(1), F.length("_word"))).alias("_at")).where(F.col("_at") < F.length("_word"))
    most = F.least(F.col("_longest"), F.length("_word") - F.col("_at") + 1)
    parts = starts.where(most > 1).select("_key", "_run", "_at", "_word", F.explode(F.sequence(F.lit(2), most)).alias("_size"))
    parts = parts.select("_key", "_run", "_at", "_size", F.col("_word").substr(F.col("_at"), F.col("_size")).alias("_part"))
    hits = parts.join(known, "_part").groupBy("_key", "_run", "_at").agg(F.max("_size").alias("_size"))
    hits = hits.groupBy("_key").agg(F.collect_list(F.struct("_run", "_at", "_size")).alias("_hits"))

    @F.pandas_udf(ArrayType(StringType()))
    def cut_runs(runs: pd.Series, hits: pd.Series) -> pd.Series:
        def cut(found, at_sizes) -> list[str]:
            sizes = {} if at_sizes is None else {(h["_run"], h["_at"]): h["_size"] for h in at_sizes}
            out = []
            for k, run in enumerate(found):
                at = 0
                while at < len(run):
                    size = sizes.get((k, at + 1), 1)
                    out.append(run[at : at + size])
                    at += size
            return out

        return pd.Series([cut(f, h) for f, h in zip(runs, hits, strict=True)], dtype=object)

    done = runs.join(hits, "_key", "left").select("_key", cut_runs("_runs", "_hits").alias(name))
    return keyed.join(done, "_key", "left").drop("_key", "_text")
