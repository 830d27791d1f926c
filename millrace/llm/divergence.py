"""How much the sources of a language differ in their use of words, over count columns kept as runs.

The kept terms of a language are put in an order in which terms with the same counts in all sources follow each other. A
source's counts in that order are a column of few runs. The order is cut into slices; in each, the runs of two sources are
intersected, and one value per common run is multiplied by its length. Slices add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import in_batches_of, landed
from millrace.llm.wordcodes import Alphabet, Codes, coded, gathered

#: Documents of a language that a kept term occurs in, at least.
LEAST_DOCS = 3
UNIT = 1_000_000_000
TOP = 200
#: Terms in a slice, counts a task holds before they leave, words it numbers before it starts anew.
SLICE_BITS = 14
ENTRIES = 2_000_000
VOCABULARY = 500_000
ROWS = 512

ALPHABET = Alphabet(set(range(128)) - set(range(65, 91)) - set(range(97, 123)))


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences and documents of each term by (lang, source): lang, source, term, n, docs. ``docs`` has lang, source, text."""
    in_batches_of(docs.sparkSession, ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, groups, parts = Codes(), {}, []
        held = 0

        def leave() -> Iterator[pa.RecordBatch]:
            nonlocal codes, groups, parts, held
            if parts:
                keys, n, own = (np.concatenate(x) for x in zip(*parts, strict=True))
                keys, n, own = _sums(keys, n, own)
                names = list(groups)
                group = pa.array((keys >> np.uint64(32)).astype(np.int64))
                term = pa.array(codes.words, pa.binary()).take(pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in names], pa.string()).take(group), pa.array([g[1] for g in names], pa.string()).take(group), term.view(pa.string()), pa.array(n), pa.array(own)],
                    ["lang", "source", "term", "n", "docs"],
                )
            codes, groups, parts, held = Codes(), {}, [], 0

        for batch in gathered(batches):
            pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            group = np.array([groups.setdefault(p, len(groups)) for p in pairs], np.uint64)
            found = [(owner.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64) for ids, _, owner in coded(batch.column("text"), ALPHABET, codes)]
            if found:
                # first by document, then by group
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                keys = (group[(keys >> np.uint64(32)).astype(np.int64)] << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
                parts.append(_sums(keys, n, np.ones(len(n), np.int64)))
                held += len(parts[-1][0])
            if held > ENTRIES:
                parts = [_sums(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
                held = len(parts[0][0])
            if held > ENTRIES // 2 and len(parts) == 1 or len(codes) > VOCABULARY:
                yield from leave()
        yield from leave()

    found = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], *(np.add.reduceat(v[order], starts) for v in values)


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """Terms (lang, term, total, place) in at least ``least_docs`` documents of their language.

    Places ascend by total and by a hash of the counts by source, which brings terms with equal counts together. What shares
    all but the low bits of its place is a slice.
    """
    one = F.xxhash64("source", "n")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.bit_xor(one).alias("mark"))
    terms = terms.filter(F.col("docs") >= least_docs).repartitionByRange("lang", "total", "mark", "term").sortWithinPartitions("lang", "total", "mark", "term")
    return landed(terms.select("lang", "term", "total", F.monotonically_increasing_id().alias("place")))


def _decimal(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _share(n: Column, size: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / size), exactly."""
    names = F.struct((_decimal(n + 1) * F.lit(UNIT).cast("decimal(10,0)")).alias("a"), _decimal(size).alias("b"))
    return F.transform(F.array(names), lambda s: F.call_function("div", s["a"], s["b"]))[0] + 1


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q), exactly."""
    return F.call_function("div", _decimal(p - q) * _decimal(p - q), _decimal(q))


class _Slice:
    """Count columns of the sources of one language over consecutive places, as runs."""

    def __init__(self, size: int) -> None:
        self.size = size

    def column(self, places: np.ndarray, counts: np.ndarray, divisor: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the runs of a column end, and the share that stands in each. Places ascend; others have count 0."""
        full = np.zeros(self.size, np.int64)
        full[places] = counts
        ends = np.append(np.flatnonzero(full[1:] != full[:-1]) + 1, self.size)
        own = full[ends - 1]
        # products past 64 bits are worked out with Python's integers
        if len(counts) and int(counts.max()) >= 9_000_000_000:
            return ends, np.array([1 + UNIT * (int(c) + 1) // divisor for c in own.tolist()], np.int64)
        return ends, 1 + UNIT * (own + 1) // divisor

    @staticmethod
    def difference(p: tuple[np.ndarray, np.ndarray], q: tuple[np.ndarray, np.ndarray]) -> int:
        """The sum of floor((p - q)**2 / q) over all places: once for each common run, times its length."""
        ends = np.union1d(p[0], q[0])
        a = p[1][np.searchsorted(p[0], ends)]
        b = q[1][np.searchsorted(q[0], ends)]
        return int((((a - b) ** 2 // b) * np.diff(ends, prepend=0)).sum())


def _pair_sums(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums over slices by pair: lang, source, item, value. ``entries``: lang, source, slice, place, n. ``groups``: lang, source,
    size (the divisor of shares)."""
    slices = entries.groupBy("lang", "slice").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    # every source of a language stands at the head of each of its slices, also where it has no count
    heads = slices.join(groups, "lang").select("lang", "slice", "source", F.lit(-1).cast("long").alias("place"), "low", "high", "size")
    body = entries.select("lang", "slice", "source", "place", "n")
    heads = heads.select("lang", "slice", "source", "place", F.col("size").alias("n"), "low", "high")
    rows = heads.unionByName(body, allowMissingColumns=True).repartition("lang", "slice").sortWithinPartitions("lang", "slice", "source", "place")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, sources, place, n, source, low, high in _slices(batches):
            slice_ = _Slice(high - low + 1)
            bounds = np.searchsorted(source, np.arange(len(sources) + 1))
            columns = [slice_.column(place[a + 1 : b] - low, n[a + 1 : b], int(n[a])) for a, b in zip(bounds, bounds[1:], strict=False)]
            for k, own in enumerate(columns):
                others = [m for m in range(len(columns)) if m != k]
                if others:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([lang] * len(others), pa.string()),
                            "source": pa.array([sources[k]] * len(others), pa.string()),
                            "item": pa.array([sources[m] for m in others], pa.string()),
                            "value": pa.array([slice_.difference(own, columns[m]) for m in others], pa.int64()),
                        }
                    )

    found = rows.mapInArrow(compare, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each slice of sorted rows: lang, names of sources, then arrays place, n, source (its number), and the lowest and highest place."""

    def whole(some: list[pa.RecordBatch]) -> tuple:
        rows = pa.concat_batches(some)
        named = rows.column("source").dictionary_encode()
        low, high = rows.column("low").drop_null()[0].as_py(), rows.column("high").drop_null()[0].as_py()
        return rows.column("lang")[0].as_py(), named.dictionary.to_pylist(), rows.column("place").to_numpy(), rows.column("n").to_numpy(), named.indices.to_numpy(), low, high

    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lang, part = batch.column("lang").dictionary_encode().indices.to_numpy(), batch.column("slice").to_numpy()
        cuts = np.flatnonzero((part[1:] != part[:-1]) | (lang[1:] != lang[:-1])) + 1
        for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            own = (batch.column("lang")[at].as_py(), int(part[at]))
            if own != key and held:
                yield whole(held)
                held = []
            key = own
            held.append(batch.slice(at, to - at))
    if held:
        yield whole(held)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """How sources differ: lang, source, part, item, value, rank.

    Part ``pair``: every other source of the language, by how far the source's shares of terms are from its shares. Part
    ``term``: the ``top`` terms that the source has more of than its language. Null text, lang and source count as ''. Each
    row is a document, repeated ones too. Ties go by the bytes of the item. A group without terms, or a language without kept
    terms, has pairs only (0 where nothing is kept). No rows give no rows; extra columns are ignored.
    """
    plain = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = landed(term_counts(plain))
    terms = kept_terms(counts, least_docs)
    found = counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "total", "place")
    entries = landed(found.withColumn("slice", F.shiftright("place", SLICE_BITS)))

    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    occurring = plain.select("lang", "source").distinct()
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = occurring.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = landed(groups.select("lang", "source", (F.coalesce("own", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("size"), (F.coalesce("all", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("lang_size")))

    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").filter("source != item")
    pairs = pairs.join(_pair_sums(entries, groups.select("lang", "source", "size")), ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    shares = entries.join(groups, ["lang", "source"]).select("lang", "source", "term", _share(F.col("n"), F.col("size")).alias("p"), _share(F.col("total"), F.col("lang_size")).alias("q"))
    own = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(own)
