"""Exact deduplication in which only rows that a Bloom filter suspects are shuffled.

Pass one sets bits for every row's hash and keeps those set more than once; the resulting filter of repeated bits has a fixed
upper size and is broadcast. In pass two a row with a clear bit is unique and passes straight through; the others are
compared exactly. A full filter only sends more rows through the shuffle: results don't depend on its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, fresh, landed

#: Bits of the filter for each row, and the largest filter: 2**27 bits are 16 MiB, small enough to broadcast at any input size.
BITS_PER_ROW = 16
MOST_BITS = 1 << 27
#: Bits of one broadcast row, as the built-in bitmap functions have it.
BLOCK = 32_768


def normal_hash(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text without white space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "").cast("binary"), 256)


def _bits(rows: int) -> int:
    bits = BLOCK
    while bits < min(MOST_BITS, BITS_PER_ROW * rows):
        bits *= 2
    return bits


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in (1, 2)]


def repeated_bits(keys: DataFrame, bits: int) -> DataFrame:
    """Blocks (``block``, ``bitmap``) of the bits that more than one row of ``keys`` (column ``key``) sets."""
    counts = keys.select(F.explode(F.array(*_positions(F.col("key"), bits))).alias("bit")).groupBy("bit").count()
    twice = counts.filter("count > 1").select((F.col("bit") + 1).alias("bit"))
    return twice.groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap")
    )


def suspects(rows: DataFrame, key: str, blocks: DataFrame, bits: int, flag: str) -> DataFrame:
    """``rows`` with boolean ``flag``: whether both bits of ``key`` are among the repeated ones."""
    columns = rows.columns
    b1, b2, m1, m2, p1, p2 = fresh(rows, "b1", "b2", "m1", "m2", "p1", "p2")
    out = rows.withColumns(dict(zip((p1, p2), _positions(F.col(f"`{key}`"), bits), strict=True)))
    for block, bitmap, position in ((b1, m1, p1), (b2, m2, p2)):
        side = blocks.select(F.col("block").alias(block), F.col("bitmap").alias(bitmap))
        out = out.join(F.broadcast(side), F.bitmap_bucket_number(out[position] + 1) == side[block], "left")

    def is_set(bitmap: str, position: str) -> Column:
        at = F.bitmap_bit_position(F.col(position) + 1).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False))

    return out.withColumn(flag, is_set(m1, p1) & is_set(m2, p2)).select(*[f"`{c}`" for c in columns], flag)


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return landed(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            normal_hash(text).alias("key"),
            F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("length"),
        )
    )


def _groups(narrow: DataFrame, blocks: DataFrame, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    marked = suspects(narrow, "key", blocks, bits, "suspect")
    doubtful = marked.filter("suspect").drop("suspect")
    groups = doubtful.groupBy("key").agg(
        F.min_by("id", F.struct(-F.col("length"), F.col("id"))).alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return marked.filter("NOT suspect").drop("suspect"), doubtful, groups


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space. The row with the most code points in its original text
    stays, then the smallest id. Null text counts as empty, so all null and blank texts are one group. Rows that repeat an id
    inside a group get the same decision; a null id is smaller than any other. No rows give no rows; extra columns are ignored.
    """
    narrow = _narrow(docs, id_col, text_col)
    bits = _bits(narrow.count())
    straight, doubtful, groups = _groups(narrow, repeated_bits(narrow, bits), bits)
    single = straight.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "key")
    compared = doubtful.join(groups, "key").select("id", "keep_id", "group_size", "key")
    return single.unionByName(compared).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("key").alias("text_sha256")
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: exactly one row of each group of equal texts.

    Unsuspected rows are never shuffled. Of suspected rows the whole rows meet the winners on (hash, id), which no hot group
    can overload. Where rows of a group tie on length and id, any one of them stays.
    """
    narrow = _narrow(docs, id_col, text_col)
    bits = _bits(narrow.count())
    blocks = landed(repeated_bits(narrow, bits))
    winners = _groups(narrow, blocks, bits)[2].select(F.col("key").alias("winner_key"), "keep_id")
    key, flag = fresh(docs, "dedup_key", "suspect")
    marked = suspects(docs.withColumn(key, normal_hash(F.col(f"`{text_col}`"))), key, blocks, bits, flag)
    straight = marked.filter(~F.col(flag))
    doubtful = marked.filter(F.col(flag))
    kept = doubtful.join(
        winners, (doubtful[key] == winners["winner_key"]) & doubtful[id_col].eqNullSafe(winners["keep_id"]), "left_semi"
    ).dropDuplicates([key])
    return straight.unionByName(kept).select(*[f"`{c}`" for c in docs.columns])
