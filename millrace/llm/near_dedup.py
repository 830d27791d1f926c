"""Near-duplicate documents: SetSketch bands propose pairs, joint likelihood thins them, full sets decide.

Documents with the same set are one node, with a number of its own; ids only come back at the end. In each band bucket all members are first compared with the smallest one, so a
group of copies costs as many pairs as it has members. Where a bucket then still holds several components, those outside its
largest one are compared with all members of other components, block by block: fingerprints of the full sets bound each
pair's similarity from above, and only pairs that may be similar enough leave the block. So every pair that shares a bucket
and isn't connected already is compared, no bucket is capped and none meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import setsketch
from millrace.llm.common import fresh, ids_and_texts, in_batches_of, landed, type_of
from millrace.llm.components import components
from millrace.llm.hashing import shingle_sets, word_hashes

#: Unless told otherwise: shingles of five words, linked from 80 % on.
WORDS, PERCENT = 5, 80
ROWS = 256
#: Members of a bucket that meet in one block, and bits of a fingerprint.
BLOCK, PRINT = 512, 16
#: 64-bit words of the filter that keeps unneeded texts out of shuffles.
BIT_WORDS = 1 << 18


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n, set_key, regs) of every row; an empty set has a null key."""
    in_batches_of(docs.sparkSession, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(*word_hashes(batch.column("text")), words)
            regs = setsketch.registers(sets)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "text_hash": batch.column("text_hash"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "set_key": pa.array(keys, pa.binary()),
                    "regs": pa.array([r.tobytes() for r in regs], pa.binary()),
                }
            )

    rows = _hashed(ids_and_texts(docs, id_col, text_col))
    return rows.mapInArrow(run, f"id {type_of(docs, id_col)}, text_hash binary, n long, set_key binary, regs binary")


def _hashed(rows: DataFrame) -> DataFrame:
    """What tells rows apart that repeat an id."""
    return rows.withColumn("text_hash", F.unhex(F.md5("text")))


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), setsketch.REGISTERS)


def _bands(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = setsketch.band_hashes(_rows_of(batch.column("regs")))
            row = pa.array(np.repeat(np.arange(len(bands)), setsketch.BANDS))
            slot = pa.array(np.tile(np.arange(setsketch.BANDS, dtype=np.int32), len(bands)))
            yield pa.RecordBatch.from_pydict({"band": pa.array(bands.reshape(-1)), "slot": slot, "node": batch.column("node").take(row)})

    return nodes.select("node", "regs").mapInArrow(run, "band long, slot int, node long")


def _texts_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, text) of ``nodes`` (node, id, text_hash): one of the equal rows each stands for."""
    found = _among(texts, nodes.select("id").distinct())
    return _hashed(found).join(nodes, ["id", "text_hash"]).select("node", "text").dropDuplicates(["node"])


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose id is in ``ids``, a table of distinct ids.

    A table of bits of the wanted ids' hashes is broadcast first, so that hardly any other row is shuffled. It has at most
    ``BIT_WORDS`` rows of two numbers, whatever the input; where most bits are set, all rows are shuffled.
    """
    h = F.xxhash64("id", F.lit(11))
    word, bit = F.pmod(h, F.lit(BIT_WORDS)).alias("_word"), F.shiftright(h, 32).bitwiseAND(F.lit(63)).cast("int")
    mask = F.expr("shiftleft(1L, _bit)")
    bits = ids.select(word, bit.alias("_bit")).groupBy("_word").agg(F.bit_or(mask).alias("_bits"))
    thin = rows.select("*", word, bit.alias("_bit")).join(F.broadcast(bits), "_word").filter(F.col("_bits").bitwiseAND(mask) != 0)
    return thin.select(*rows.columns).join(ids, "id")  # not a semi join, which would be pushed below the filter


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of nodes (a, b) whose full sets are similar enough."""
    spark = pairs.sparkSession
    in_batches_of(spark, ROWS)

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
            keep = setsketch.likely(_rows_of(batch.column("regs_a")), _rows_of(batch.column("regs_b")), n_a, n_b, percent / 100)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = shingle_sets(*word_hashes(batch.column("text_a")), words)
            right = shingle_sets(*word_hashes(batch.column("text_b")), words)
            keep = []
            for x, y in zip(left, right, strict=True):
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(df: DataFrame, name: str, *columns: str) -> DataFrame:
        return df.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    joined = pairs.join(side(nodes, "b", "n", "regs"), "b").join(side(nodes, "a", "n", "regs"), "a")
    near = joined.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    hopeful = landed(near.mapInArrow(estimated, "a long, b long"))
    asked = hopeful.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = _texts_of(nodes.select("node", "id", "text_hash").join(asked, "node"), texts)
    both = hopeful.join(side(wanted, "b", "text"), "b").join(side(wanted, "a", "text"), "a")
    return landed(both.mapInArrow(verified, "a long, b long"))


def _prints(rows: DataFrame, words: int) -> DataFrame:
    """(node, prints): 16 bits of each shingle of (node, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(*word_hashes(batch.column("text")), words)
            prints = [(s >> np.uint64(64 - PRINT)).astype("<u2").tobytes() for s in sets]
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "prints": pa.array(prints, pa.binary())})

    return rows.mapInArrow(run, "node long, prints binary")


def _strays(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of a bucket that lie in different components and whose sets may be similar enough."""
    placed = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = placed.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n_label"))
    bands = sizes.groupBy("band").agg(F.max_by("label", "n_label").alias("main"), F.count(F.lit(1)).alias("n_labels"), F.sum("n_label").alias("total"), F.max("n_label").alias("n_main"))
    loose = placed.drop("members", "hub").join(bands.filter("n_labels > 1").drop("n_labels"), "band")
    loose = landed(loose.withColumn("stray", F.col("label") != F.col("main")).drop("main"))
    wanted = nodes.select("node", "id", "text_hash").join(loose.select("node").distinct(), "node")
    data = landed(nodes.select("node", "n", "regs").join(_prints(_texts_of(wanted, texts), words), "node"))
    full = loose.join(data, "node")
    blocks, stray_blocks = (F.ceil(n / BLOCK).cast("int") for n in (F.col("total"), F.col("total") - F.col("n_main")))
    own = F.xxhash64("node", F.lit(7))
    keys = ["band", "block", "stray_block"]

    def dealt(rows: DataFrame, mine: str, mine_of, other: str, others, asks: bool) -> DataFrame:
        rows = rows.withColumn(mine, F.pmod(own, mine_of).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), others - 1)))
        return rows.select(*keys, F.lit(asks).alias("asks"), "slot", "stray", "node", "label", "n", "regs", "prints")

    members = dealt(full, "block", blocks, "stray_block", stray_blocks, False)
    strays = dealt(full.filter("stray"), "stray_block", stray_blocks, "block", blocks, True)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches, keys):
            if found := _pairs_of(block, percent):
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    met = members.unionByName(strays).repartition(*keys).sortWithinPartitions(*keys)
    return met.mapInArrow(compared, "a long, b long").distinct()


def _blocks_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, one key after the other, of batches that are sorted by key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        found = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], 1)
        cuts = [0, *(np.flatnonzero((found[1:] != found[:-1]).any(1)) + 1).tolist(), len(found)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(found[start].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _pairs_of(block: pa.Table, percent: int) -> list[tuple]:
    """Pairs of a stray and a member of one block, in different components, whose sets may be similar enough.

    A pair is taken up in the first band that it shares, and from the larger number where both are strays.
    """
    asks = block.column("asks").to_numpy()
    left, right = np.flatnonzero(~asks), np.flatnonzero(asks)
    if not len(left) or not len(right):
        return []
    slot = block.column("slot")[0].as_py()
    ids, label, n, stray = (block.column(c).to_numpy() for c in ("node", "label", "n", "stray"))
    regs = np.frombuffer(b"".join(block.column("regs").to_pylist()), np.uint16).reshape(len(ids), -1)[:, : setsketch.BANDS * setsketch.ROWS]
    prints = [np.frombuffer(p, "<u2") for p in block.column("prints").to_pylist()]
    hit = np.zeros(1 << PRINT, bool)
    out = []
    for k in right.tolist():
        maybe = (label[left] != label[k]) & (100 * np.minimum(n[left], n[k]) >= percent * np.maximum(n[left], n[k]))
        near = left[maybe & (~stray[left] | (ids[left] < ids[k]))]
        if not len(near):
            continue
        same = (regs[near] == regs[k]).reshape(len(near), setsketch.BANDS, setsketch.ROWS).all(2)
        near = near[same[:, slot] & (same.argmax(1) == slot)]
        if not len(near):
            continue
        hit[prints[k]] = True
        common = np.array([np.count_nonzero(hit[prints[j]]) for j in near.tolist()])
        hit[prints[k]] = False
        common = np.minimum(common, np.minimum(n[near], n[k]))
        for x in ids[near[100 * common >= percent * (n[near] + n[k] - common)]].tolist():
            out.append((min(x, ids[k]), max(x, ids[k])))
    return out


def classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable over links), kept.

    Linked are documents with 100 * intersection >= percent * union of their shingle sets. Null, empty and blank texts have
    no shingles and no links. Rows that repeat an id are judged by their own texts: each is a document of its own, and of an id
    that is the smallest of its component every row with it in that component is kept. A row without an id has no links, no
    component and is kept. No rows give no rows; extra columns are ignored.
    """
    return _judged(docs, words, percent, id_col, text_col).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def _judged(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, component_id, kept) of every row of ``docs``."""
    signed = landed(signatures(docs, words, id_col, text_col))
    rows = signed.filter("n > 0 AND id IS NOT NULL")
    sets = rows.groupBy("set_key").agg(
        F.min(F.struct("id", "text_hash")).alias("first"), F.any_value("n").alias("n"), F.any_value("regs").alias("regs")
    )
    # numbered once and written, so that a lost executor can't number them anew
    nodes = landed(sets.select(F.monotonically_increasing_id().alias("node"), "set_key", "first.*", "n", "regs"))
    bands = _bands(nodes)
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("hub")).filter("members > 1")
    buckets = landed(bands.join(sizes, "band"))
    texts = ids_and_texts(docs, id_col, text_col)
    pairs = buckets.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = _confirmed(pairs, nodes, texts, words, percent)
    labels = components(links)
    found = landed(_strays(buckets, labels, nodes, texts, words, percent))
    if not found.isEmpty():
        labels = components(links.unionByName(_confirmed(found, nodes, texts, words, percent)))
    members = nodes.select("set_key", "node", F.col("id").alias("first_id")).join(labels, "node", "left")
    smallest = members.filter("label IS NOT NULL").groupBy("label").agg(F.min("first_id").alias("least_id"))
    members = members.join(smallest, "label", "left").select("set_key", F.coalesce("least_id", "first_id").alias("component_id"))
    out = signed.select("id", "text_hash", "n", "set_key").join(members, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    kept = F.coalesce(F.col("id") == component, F.lit(True))
    return out.select("id", "text_hash", "n", component.alias("component_id"), kept.alias("kept"))


def deduplicate(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, and rows without an id; all columns.

    Rows that repeat an id go or stay by their own texts.
    """
    dropped = _judged(docs, words, percent, id_col, text_col).filter("NOT kept").select(F.col("id").alias("dropped_id"), "text_hash").distinct()
    (name,) = fresh(docs, "text_hash")
    hashed = docs.withColumn(name, F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))))
    gone = (hashed[f"`{id_col}`"] == dropped["dropped_id"]) & (hashed[name] == dropped["text_hash"])
    return hashed.join(dropped, gone, "left_anti").select(*[f"`{c}`" for c in docs.columns])
