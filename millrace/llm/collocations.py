"""Phrases whose words belong together, mined per language from HAT-tries that each task fills and spills.

A task counts word sequences in a shallow trie over numbered words whose leaves are hash tables; a table that grows bursts
into a further trie level. When the trie is full its largest subtrees leave it whole, as runs sorted by phrase, which are dealt
out by prefix and merged.

Sequences of n words are counted after those of n - 1: one that is frequent has two frequent parts, so each task only counts
where a bitmap of the frequent parts (of a fixed largest size; a false answer costs a row, never a result) says yes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import in_batches_of, landed
from millrace.llm.wordcodes import Alphabet, Codes, coded, gathered

WORDS = 4
#: Words by which runs are dealt out.
PREFIX = 3
LEAST = 30
TOP = 2000
#: Entries of a hash table before it bursts, entries of all tries of a task before subtrees leave, words before all do.
BURST = 4096
ENTRIES = 1_000_000
VOCABULARY = 1_000_000
#: Largest bitmap of frequent parts: 2**27 bits are 16 MiB, small enough for every worker at any size of the input.
MOST_BITS = 1 << 27
BITS_PER_PHRASE = 16
BLOCK_BITS = 32_768
ROWS = 512
RUN_ROWS = 100_000
#: First ids that share a table until it bursts.
RANGE = 64
UNKNOWN = "und"

ALPHABET = Alphabet(b" \t", b".,;:!?\n\x0b\x0c\r")
_ID = 32


class _Node:
    """A trie level: next id to a hash table or a further level."""

    __slots__ = ("children",)

    def __init__(self) -> None:
        self.children: dict[int, dict[int, int] | _Node] = {}


class HatTrie:
    """Counts of sequences of ``width`` ids, packed into one integer with 32 bits for each id, the first one highest.

    Below the root, one table holds all sequences whose first id lies in the same range, until it bursts into one for each id.
    """

    def __init__(self, width: int, burst: int = BURST) -> None:
        self.width, self.burst, self.size = width, burst, 0
        self.root = _Node()

    def add(self, heads: np.ndarray, keys: list[int], counts: list[int]) -> None:
        """Add to the counts of sequences, which ascend; ``heads`` are their first ids."""
        if not len(heads):
            return
        ranges = heads // RANGE
        bounds = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1], [True]])).tolist()
        for own, at, to in zip(ranges[bounds[:-1]].tolist(), bounds, bounds[1:], strict=False):
            self._put(self.root, own, self.width, keys[at:to], counts[at:to])

    def _put(self, node: _Node, below: int, width: int, keys: list[int], counts: list[int]) -> None:
        child = node.children.get(below)
        if child is None:
            child = node.children[below] = {}
        if isinstance(child, _Node):
            shift, at = _ID * (width - 1), 0
            rest = (1 << shift) - 1
            while at < len(keys):
                head = keys[at] >> shift
                to = bisect_left(keys, (head + 1) << shift, at)
                self._put(child, head, width - 1, [k & rest for k in keys[at:to]], counts[at:to])
                at = to
            return
        before, get = len(child), child.get
        for key, count in zip(keys, counts, strict=True):
            child[key] = get(key, 0) + count
        self.size += len(child) - before
        if width > 1 and len(child) > self.burst:
            node.children[below] = self._burst(child, width)

    @staticmethod
    def _burst(table: dict[int, int], width: int) -> _Node:
        node, shift = _Node(), _ID * (width - 1)
        rest = (1 << shift) - 1
        for key, count in table.items():
            node.children.setdefault(key >> shift, {})[key & rest] = count
        return node

    def subtrees(self) -> list[tuple[int, int]]:
        """Size and name of what hangs below the root."""
        return [(_size(child), name) for name, child in self.root.children.items()]

    def take(self, names: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Remove subtrees and return their sequences, a column for each id, and their counts."""
        keys: list[int] = []
        counts: list[int] = []
        for name in names:
            _flatten(self.root.children.pop(name), self.width, 0, keys, counts)
        self.size -= len(keys)
        words = [keys] if self.width <= 2 else [[k >> 2 * _ID for k in keys], [k & (1 << 2 * _ID) - 1 for k in keys]]
        columns = []
        for packed, ids in zip(words, ([self.width] if self.width <= 2 else [self.width - 2, 2]), strict=True):
            packed = np.array(packed, np.uint64)
            columns += [(packed >> np.uint64(_ID * k) & np.uint64((1 << _ID) - 1)).astype(np.int64) for k in range(ids - 1, -1, -1)]
        return np.stack(columns, 1), np.array(counts, np.int64)


def _size(child: dict | _Node) -> int:
    return sum(map(_size, child.children.values())) if isinstance(child, _Node) else len(child)


def _flatten(child: dict | _Node, width: int, prefix: int, keys: list[int], counts: list[int]) -> None:
    if isinstance(child, _Node):
        for head, below in child.children.items():
            _flatten(below, width - 1, prefix | head << _ID * (width - 1), keys, counts)
    else:
        keys.extend([prefix | k for k in child] if prefix else child)
        counts.extend(child.values())


class Bitmap:
    """The frequent phrases of one length, as bits of their hashes."""

    def __init__(self, bits: int, blocks: list[tuple[int, bytes]]) -> None:
        self.bits = bits
        self.data = np.zeros(bits // 8, np.uint8)
        for block, data in blocks:
            at = (block - 1) * BLOCK_BITS // 8
            self.data[at : at + len(data)] = np.frombuffer(data, np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _turn(k: int) -> int:
    return (13 * (k + 1)) % 64


def _hash_column(lang: Column, words: Column, n: int) -> Column:
    out = F.xxhash64(lang)
    for k in range(n):
        one = F.xxhash64(words[k])
        out = out.bitwiseXOR(F.shiftleft(one, _turn(k)).bitwiseOR(F.shiftrightunsigned(one, 64 - _turn(k))))
    return out


def _hash_runs(lang: np.uint64, hashes: np.ndarray, n: int) -> np.ndarray:
    """The same hash for each run of ``n`` words."""
    out = np.full(max(0, len(hashes) - n + 1), lang)
    for k in range(n):
        one = hashes[k : k + len(out)]
        out ^= (one << np.uint64(_turn(k))) | (one >> np.uint64(64 - _turn(k)))
    return out


def bitmap_of(frequent: DataFrame, n: int) -> Bitmap:
    """Bits of ``frequent`` (lang, phrase; phrases of ``n`` words). At most 16 MiB come to the driver."""
    rows, bits = frequent.count(), BLOCK_BITS
    while bits < min(MOST_BITS, BITS_PER_PHRASE * rows):
        bits *= 2
    at = _hash_column(F.col("lang"), F.split("phrase", " "), n).bitwiseAND(F.lit(bits - 1)) + 1
    found = frequent.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("block"))
    found = found.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    return Bitmap(bits, [(r.block, bytes(r.bits)) for r in found.collect()])


def _counted(ids: np.ndarray, first: np.ndarray, n: int, wanted: np.ndarray | None) -> tuple[np.ndarray, list[int], list[int]]:
    """The distinct runs of ``n`` words inside pieces, ascending, as ``HatTrie.add`` takes them. ``wanted`` says which runs of
    ``n - 1`` words are of interest."""
    size = max(0, len(ids) - n + 1)
    inside = np.ones(size, bool)
    for k in range(1, n):
        inside &= ~first[k : k + size]
    if wanted is not None:
        inside &= wanted[:size] & wanted[1 : size + 1]
    at = np.flatnonzero(inside)
    ids, low = ids.astype(np.uint64), np.uint64((1 << _ID) - 1)
    if n == 1:
        keys, counts = np.unique(ids[at], return_counts=True)
        return keys, keys.tolist(), counts.tolist()
    pairs = [(ids[at + k] << np.uint64(_ID)) | ids[at + k + 1] for k in range(0, n - 1, 2)]
    if n == 2:
        keys, counts = np.unique(pairs[0], return_counts=True)
        return keys >> np.uint64(_ID), keys.tolist(), counts.tolist()
    # the ranks of pairs are ordered as they are
    starts, rank = np.unique(pairs[0], return_inverse=True)
    ends, tail = np.unique(pairs[1] if n == 4 else ids[at + 2], return_inverse=True)
    keys, counts = np.unique((rank.astype(np.uint64) << np.uint64(_ID)) | tail.astype(np.uint64), return_counts=True)
    start, shift = starts[keys >> np.uint64(_ID)], _ID * (n - 2)
    packed = [s << shift | e for s, e in zip(start.tolist(), ends[keys & low].tolist(), strict=True)]
    return start >> np.uint64(_ID), packed, counts.tolist()


def _run(sequences: np.ndarray, counts: np.ndarray, lang: str, words: pa.Array, rank: np.ndarray) -> pa.RecordBatch:
    """Sequences as phrases, sorted word by word. ``words`` ascend, ``rank`` has their places by id."""
    own = rank[sequences]
    order = np.lexsort(own.T[::-1])
    columns = [words.take(pa.array(c)) for c in own[order].T]
    phrases = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())) if len(columns) > 1 else columns[0]
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(order), np.int8)))
    return pa.RecordBatch.from_arrays([langs, phrases.view(pa.string()), pa.array(counts[order])], ["lang", "phrase", "a"])


def runs(texts: DataFrame, n: int, parts: Bitmap | None = None, burst: int = BURST, entries: int = ENTRIES) -> DataFrame:
    """Sorted runs (lang, phrase, a) of the phrases of ``n`` words in ``texts`` (lang, text): a phrase comes once in a run.

    With ``parts`` only phrases count whose first and last n - 1 words it holds.
    """
    spark = texts.sparkSession
    in_batches_of(spark, ROWS)
    shared = spark.sparkContext.broadcast(parts) if parts is not None else None

    def spill(tries: dict[str, HatTrie], codes: Codes, most: int) -> Iterator[pa.RecordBatch]:
        """The largest subtrees, until no more than ``most`` entries are left."""
        subtrees = sorted(((size, lang, name) for lang, t in tries.items() for size, name in t.subtrees()), reverse=True)
        held = sum(s[0] for s in subtrees)
        leaving: dict[str, list[int]] = {}
        for size, lang, name in subtrees:
            if held <= most:
                break
            leaving.setdefault(lang, []).append(name)
            held -= size
        if not leaving:
            return
        words = pa.array(codes.words, pa.binary())
        order = pc.array_sort_indices(words)
        rank = np.empty(len(words), np.int64)
        rank[order.to_numpy()] = np.arange(len(words))
        words = words.take(order)
        for lang, names in leaving.items():
            run = _run(*tries[lang].take(names), lang, words, rank)
            for at in range(0, len(run), RUN_ROWS):
                yield run.slice(at, RUN_ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, HatTrie] = {}
        codes, done = Codes(), [0]
        for batch in gathered(batches):
            named = batch.column("lang").dictionary_encode()
            for k, lang in enumerate(named.dictionary.to_pylist()):
                own = batch.column("text").filter(pa.array(named.indices.to_numpy() == k))
                trie = tries.setdefault(lang, HatTrie(n, burst))
                for ids, first, _ in coded(own, ALPHABET, codes, n - 1):
                    wanted = None
                    if shared is not None:
                        seed = np.uint64(xxhash64(lang))
                        wanted = shared.value.holds(_hash_runs(seed, codes.hashes(done)[ids], n - 1))
                    trie.add(*_counted(ids, first, n, wanted))
            if len(codes) > VOCABULARY:
                yield from spill(tries, codes, 0)
                codes, done = Codes(), [0]
            elif sum(t.size for t in tries.values()) > entries:
                yield from spill(tries, codes, entries // 2)
        yield from spill(tries, codes, 0)

    return texts.mapInArrow(count, "lang string, phrase string, a long")


def xxhash64(text: str) -> int:
    """What Spark's function gives for one string, as an unsigned integer."""
    return xxhash.xxh64_intdigest(text.encode(), 42)


def merged(found: DataFrame, n: int) -> DataFrame:
    """Runs of phrases of ``n`` words merged in partitions by prefix. A prefix has up to three words, since those of one or two
    can be hot."""
    prefix = F.substring_index("phrase", " ", PREFIX) if n > PREFIX else F.col("phrase")
    dealt = found.select("lang", prefix.alias("prefix"), "phrase", "a") if n > PREFIX else found.withColumnRenamed("phrase", "prefix")
    keys = ["lang", "prefix", "phrase"] if n > PREFIX else ["lang", "prefix"]
    sums = dealt.repartition("lang", "prefix").groupBy(*keys).agg(F.sum("a").alias("a"))
    return sums.select("lang", F.col(keys[-1]).alias("phrase"), "a")


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, most_words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``most_words`` words seen ``least`` times or more in a language (lang, phrase, n_words, a), and the
    number of words of each language (lang, n)."""
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    out = totals = parts = None
    for n in range(1, most_words + 1):
        found = merged(runs(texts, n, parts), n)
        if n == 1:  # the totals need the rare words too
            found = landed(found)
            totals = found.groupBy("lang").agg(F.sum("a").alias("n"))
        frequent = landed(found.filter(F.col("a") >= least))
        if n < most_words:
            parts = bitmap_of(frequent, n)
        frequent = frequent.select("lang", "phrase", F.lit(n).alias("n_words"), "a")
        out = frequent if out is None else out.unionByName(frequent)
    return out, totals


def _exact(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (two words or more) with their lowest-scoring cut: lang, phrase, n_words, a, l, r, score."""
    cuts = phrases.filter("n_words > 1").withColumn("k", F.explode(F.expr("sequence(1, n_words - 1)")))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - n_words)"))
    left = phrases.select(F.col("lang").alias("lang_l"), F.col("phrase").alias("phrase_l"), F.col("a").alias("l"))
    right = phrases.select(F.col("lang").alias("lang_r"), F.col("phrase").alias("phrase_r"), F.col("a").alias("r"))
    cuts = cuts.join(left, (cuts["lang"] == left["lang_l"]) & (cuts["first"] == left["phrase_l"]))
    cuts = cuts.join(right, (cuts["lang"] == right["lang_r"]) & (cuts["rest"] == right["phrase_r"]))
    cuts = cuts.withColumn("product", _exact("a") * F.lit(2_000_000).cast("decimal(10,0)")).withColumn("parts", _exact("l") + _exact("r"))
    cuts = cuts.withColumn("score", F.expr("product DIV parts"))
    best = cuts.groupBy("lang", "phrase", "n_words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "n_words", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def covered(phrases: DataFrame, percent: int = 80) -> DataFrame:
    """For each phrase inside a longer one (lang, phrase): ``most``, the largest count of such a longer phrase."""
    words = F.split("phrase", " ")

    def inner(size: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.col("n_words") - size + 1), lambda i: F.array_join(F.slice(words, i, size), " "))
        return F.when(F.col("n_words") > size, every).otherwise(F.array().cast("array<string>"))

    within = phrases.filter("n_words > 2").select("lang", F.explode(F.concat(*map(inner, range(2, WORDS)))).alias("phrase"), "a")
    return within.groupBy("lang", "phrase").agg(F.max("a").alias("most"))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null text has no words, a null language is ``und``. Ties go to the more frequent phrase, then to the smaller one by
    bytes. Repeated rows count again. No rows, or no phrase seen often enough, give no rows; extra columns are ignored.
    """
    phrases, totals = frequent_phrases(docs, text_col, lang_col, least)
    found = scored(phrases).join(covered(phrases), ["lang", "phrase"], "left")
    found = found.filter(F.col("most").isNull() | (100 * _exact("most") < 80 * _exact("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return found.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
