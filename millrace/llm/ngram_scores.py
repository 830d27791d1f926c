"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Words and word pairs of the training documents are counted; an n-gram whose count has the quantised logarithm q is put into
the filter q times, as (n-gram, 1) to (n-gram, q). Asking for (n-gram, 1), (n-gram, 2), ... until one is missing gives the
count back. The filter consists of blocks, ranges of hashes whose number follows the corpus, and an n-gram has all its bits in its
own block. Shards are ranges of blocks: they settle how the filter lies, never what it answers. Where executors mount the shared
folder, the filter is one file there that all workers of a machine map into memory, so no process holds a copy of it. Elsewhere
one up to BROADCAST_BYTES is broadcast to the workers; a larger one stays where it is, and each chunk of documents sends its
distinct n-grams to the shards instead. All ways give the same scores.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ids_and_texts, in_batches_of, landed, shared_folder, type_of
from millrace.llm.hashing import mix, word_hashes
from millrace.llm.token_files import is_mounted, local_path

ROWS = 256
#: Bytes of an Arrow batch sent to Python, and of text scored together: rows of some columns have megabytes, texts can be long.
BATCH_BYTES = 8 << 20
SCORED_BYTES = 2 << 20
#: Base of the logarithm of counts, probes for each entry and bits for each entry (six probes: 1.6 % false answers).
COUNT_BASE, PROBES, BITS = 1.5, 6, 8.66
#: Empty bytes behind the data of a filter, for blocks that nothing was learned for.
PAD = 8
#: Weight of the pair against the single word where the first word is known.
PAIR_WEIGHT = 0.5
#: Training text for each block of the filter, and for each shard.
BLOCK_BYTES = 128 << 10
SHARD_BYTES = 16 << 20
BROADCAST_BYTES = 256 << 20
#: Tokens counted or scored together: what they send to a shard shrinks only as shards grow in number, not with the batches.
TOGETHER = 1 << 20

_ODD = np.uint64(0xD6E8FEB86659FD93)
START, END, SINGLE = (np.uint64(x) for x in (0xA3EC647659359ACD, 0x5851F42D4C957F2D, 0x14057B7EF767814F))


def held_out(id_col: str) -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed tokens (words and an end) of all texts, what stands before each, and the number of tokens of each text."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    return np.insert(words, ends, END), np.insert(words, ends - counts, START), counts + 1


def word_keys(tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(tokens + SINGLE)


def pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before * _ODD + tokens)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard (or block) by the highest bits, so in the order of the keys; ``shards`` is a power of two."""
    return (keys >> np.uint64(33)).astype(np.int64) * shards >> 31


def _places(keys: np.ndarray, level: int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        one = mix(keys + np.uint64(level) * SINGLE)
        two = mix(one) | np.uint64(1)
        for k in range(PROBES):
            yield ((one + np.uint64(k) * two) % np.asarray(bits, np.uint64)).astype(np.int64)


def quantised(counts: np.ndarray) -> np.ndarray:
    return 1 + np.round(np.log(counts) / np.log(COUNT_BASE)).astype(np.int64)


def estimate(levels: np.ndarray) -> np.ndarray:
    return np.where(levels > 0, COUNT_BASE ** (levels - 1.0), 0.0)


def build(keys: np.ndarray, counts: np.ndarray, blocks: int, first: int, own: int, each: float = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the ``own`` blocks from ``first`` on, of ``blocks`` in all, for distinct ``keys``;
    and the bits of each block, which has ``each`` bits for an entry."""
    levels = quantised(counts)
    block = shard_of(keys, blocks) - first
    bits = np.maximum(64, (each * np.bincount(block, levels, own)).astype(np.int64))
    starts = _starts(bits)
    data = np.zeros(starts[-1], np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        some = levels >= level
        for at in _places(keys[some], level, bits[block[some]]):
            np.bitwise_or.at(data, (at >> 3) + starts[block[some]], (1 << (at & 7)).astype(np.uint8))
    return data, bits


def _starts(bits: np.ndarray) -> np.ndarray:
    """Where each block begins, in bytes, and the end."""
    return np.concatenate([[0], np.cumsum((bits + 7) >> 3)])


class Counts:
    """The blocks of some shards that lie side by side, from block ``low`` on, and their exact word counts by ascending word key.

    ``bits`` has the size of each block and ``first`` where in ``data`` it begins.
    """

    def __init__(self, blocks: int, low: int, data: np.ndarray, bits: np.ndarray, first: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> None:
        self.blocks, self.low, self.data, self.bits, self.first, self.keys, self.counts = blocks, low, data, bits, first, keys, counts

    @classmethod
    def of(cls, rows: Iterable[dict], blocks: int, shards: int, low: int, high: int, data_bytes: int, types: int) -> Counts:
        """``rows`` come one after another and are copied to where they belong, so that only one is held besides the whole."""
        per = blocks // shards
        data = np.zeros(data_bytes + PAD, np.uint8)
        bits, first = _empty_blocks((high - low) * per, data_bytes)
        keys, counts = np.zeros(types, np.uint64), np.zeros(types, np.int64)
        at = known = 0
        for r in rows:
            _put_blocks(bits, first, r, low, per, at)
            data[at : at + len(r["data"])] = np.frombuffer(r["data"], np.uint8)
            keys[known : known + r["types"]] = word_keys(np.frombuffer(r["words"], "<u8"))
            counts[known : known + r["types"]] = np.frombuffer(r["word_counts"], "<u8")
            at, known = at + len(r["data"]), known + r["types"]
        order = np.argsort(keys)
        return cls(blocks, low * per, data, bits, first, keys[order], counts[order])

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Quantised counts of n-gram keys, 0 where absent. Each key is looked up once, in the order in which the filter lies."""
        keys, back = np.unique(keys, return_inverse=True)
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        block = shard_of(keys, self.blocks) - self.low
        bits, first = self.bits[block], self.first[block]
        level = 0
        while len(left):
            level += 1
            hit = np.ones(len(left), bool)
            for at in _places(keys[left], level, bits[left]):
                byte = self.data[(at >> 3) + first[left]]
                hit &= (byte >> (at & 7).astype(np.uint8)) & 1 == 1
            left = left[hit]
            out[left] = level
        return out[back]

    def exact(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(tokens), np.int64)
        keys, back = np.unique(word_keys(tokens), return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)[back]


def _empty_blocks(n: int, data_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits and beginnings of blocks that nothing was learned for: each has the empty bytes behind the data."""
    return np.full(n, 8 * PAD, np.uint64), np.full(n, data_bytes, np.int64)


def _put_blocks(bits: np.ndarray, first: np.ndarray, row: dict, low: int, per: int, at: int) -> None:
    """Enter the blocks of a shard whose data begins ``at``."""
    own, found = slice((row["shard"] - low) * per, (row["shard"] - low + 1) * per), np.frombuffer(row["bits"], "<i8")
    bits[own], first[own] = found, at + _starts(found)[:-1]


def _sums(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, counts, len(found)).astype(np.uint64)


def _cut(keys: np.ndarray, shards: int, *columns: np.ndarray) -> tuple[pa.Array, list[pa.Array]]:
    """The shards of ascending ``keys`` that occur, and each column cut by them into bytes."""
    shard, at = np.unique(shard_of(keys, shards), return_index=True)
    at, ends = at.tolist(), [*at.tolist(), len(keys)]
    rows = [memoryview(np.ascontiguousarray(c)).cast("B") for c in columns]
    cuts = [[r[a * c.itemsize : b * c.itemsize] for a, b in zip(at, ends[1:], strict=True)] for r, c in zip(rows, columns, strict=True)]
    return pa.array(shard), [pa.array(map(bytes, c), pa.binary()) for c in cuts]


def _part(folder: str, shard: int) -> str:
    return os.path.join(folder, f"shard-{shard:07d}")


def learn(training: DataFrame, shards: int, blocks: int, bits_each: float = BITS, folder: str | None = None) -> DataFrame:
    """Shards of the model from (id, text) rows: shard, bits (of its blocks), data, words, word_counts, tokens, types, data_bytes.

    With a mounted ``folder``, data, word keys in their order and counts go there, to a file of each shard, and not into the rows.
    """
    in_batches_of(training.sparkSession, ROWS, BATCH_BYTES)

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate([t for t, _ in held])
        before = np.concatenate([b for _, b in held])
        pairs = np.concatenate([pair_keys(before, tokens), word_keys(before[before == START])])
        for kind, keys in (("word", tokens), ("pair", pairs)):
            keys, counts = _sums(keys)
            if kind == "word":
                order = np.argsort(word_keys(keys))
                keys, counts = keys[order], counts[order]
            shard, (grams, numbers) = _cut(word_keys(keys) if kind == "word" else keys, shards, keys, counts.astype("<u4"))
            yield pa.RecordBatch.from_pydict({"shard": shard, "kind": [kind] * len(shard), "grams": grams, "counts": numbers})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            tokens, before, _ = tokens_of(batch.column("text"))
            held.append((tokens, before))
            n += len(tokens)
            if n >= TOGETHER:
                yield from flush(held)
                held, n = [], 0
        if held:
            yield from flush(held)

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        def all_of(kind: str) -> tuple[np.ndarray, np.ndarray]:
            own = rows[rows["kind"] == kind]
            return _sums(np.frombuffer(b"".join(own["grams"]), "<u8"), np.frombuffer(b"".join(own["counts"]), "<u4"))

        words, word_counts = all_of("word")
        pairs, pair_counts = all_of("pair")
        shard, per = int(rows["shard"].iloc[0]), blocks // shards
        data, bits = build(np.concatenate([word_keys(words), pairs]), np.concatenate([word_counts, pair_counts]), blocks, shard * per, per, bits_each)
        own = [data, words, word_counts.astype("<u8")]
        if folder is not None:
            keys = word_keys(words)
            order = np.argsort(keys)
            os.makedirs(folder, exist_ok=True)
            attempt = f"{_part(folder, shard)}.{uuid.uuid4().hex}"
            with open(attempt, "wb") as out:
                for column in (data, keys[order].astype("<u8"), own[2][order]):
                    out.write(column)
            os.replace(attempt, _part(folder, shard))
            own = [np.zeros(0, np.uint8)] * 3
        row = [shard, bits.astype("<i8").tobytes(), *(x.tobytes() for x in own), int(word_counts.sum()), len(words), len(data)]
        return pd.DataFrame([row], columns=["shard", "bits", "data", "words", "word_counts", "tokens", "types", "data_bytes"])

    counted = training.select("text").mapInArrow(count, "shard long, kind string, grams binary, counts binary")
    model = counted.groupBy("shard").applyInPandas(
        gather, "shard long, bits binary, data binary, words binary, word_counts binary, tokens long, types long, data_bytes long"
    )
    return landed(model)


def _scores(tokens: np.ndarray, before: np.ndarray, sizes: np.ndarray, levels, exact, total: int, types: int) -> dict[str, np.ndarray]:
    """Columns of some documents, given functions for quantised and exact counts."""
    kinds, at = np.unique(np.concatenate([tokens, before]), return_inverse=True)
    own, first = at[: len(tokens)], at[len(tokens) :]
    known, seen = exact(kinds), estimate(levels(word_keys(kinds)))
    single = (seen + 1) / (total + types + 1)
    pair = estimate(levels(pair_keys(before, tokens)))
    context = seen[first]
    share = np.where(seen[own] > 0, np.minimum(1.0, pair / np.maximum(context, 1)), 0.0)
    p = np.where(context > 0, PAIR_WEIGHT * share + (1 - PAIR_WEIGHT) * single[own], single[own])
    starts = np.cumsum(sizes) - sizes
    return {
        "n_tokens": sizes,
        "n_known": np.add.reduceat((known[own] > 0).astype(np.int64), starts),
        "base_score": np.add.reduceat(np.log10((known[own] + 1) / (total + types + 1)), starts),
        "score": np.add.reduceat(np.log10(p), starts),
    }


class _Way(NamedTuple):
    """How the model lies, and its totals."""

    blocks: int
    shards: int
    total: int
    types: int


_SCORED = "n_tokens long, n_known long, base_score double, score double"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about SCORED_BYTES of text."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SCORED_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def _scored(batches: Iterator[pa.RecordBatch], counts: Counts, way: _Way) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in _slices(batch):
            columns = _scores(*tokens_of(rows.column("text")), counts.levels, counts.exact, way.total, way.types)
            yield pa.RecordBatch.from_pydict({"id": rows.column("id")} | {k: pa.array(v) for k, v in columns.items()})


class _Lies(NamedTuple):
    """A filter in one file: ``data_bytes`` of data, PAD empty ones and some to a multiple of eight, then word keys and counts."""

    path: str
    data_bytes: int
    types: int

    def columns(self) -> tuple[int, int, int]:
        """Where word keys and counts begin, and the end."""
        keys = (self.data_bytes + PAD + 7) & ~7
        return keys, keys + 8 * self.types, keys + 16 * self.types

    def opened(self, way: _Way, bits: np.ndarray, first: np.ndarray) -> Counts:
        keys, counts, end = self.columns()
        whole = np.asarray(np.memmap(self.path, np.uint8, "r", shape=end))
        return Counts(way.blocks, 0, whole[:keys], bits, first, whole[keys:counts].view("<u8"), whole[counts:end].view("<i8"))


def _joined(model: DataFrame, folder: str, way: _Way, data_bytes: int) -> tuple[_Lies, np.ndarray, np.ndarray]:
    """The files of all shards put together in the order of the shards, so in the order of keys; bits and beginnings of blocks."""
    lies = _Lies(os.path.join(folder, "whole"), data_bytes, way.types)
    bits, first = _empty_blocks(way.blocks, data_bytes)
    parts, at, known = [], 0, 0
    for row in model.select("shard", "bits", "types", "data_bytes").orderBy("shard").toLocalIterator():
        _put_blocks(bits, first, row.asDict(), 0, way.blocks // way.shards, at)
        parts.append((row["shard"], at, row["data_bytes"], known, row["types"]))
        at, known = at + row["data_bytes"], known + row["types"]

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task that runs again writes the same bytes to the same place."""
        keys, counts, end = lies.columns()
        for batch in batches:
            out = os.open(lies.path, os.O_CREAT | os.O_RDWR, 0o644)
            os.ftruncate(out, end)
            for part in batch.to_pylist():
                whole = memoryview(np.memmap(_part(folder, part["shard"]), np.uint8, "r"))
                size, words = part["data_bytes"], 8 * part["types"]
                for place, piece in (
                    (part["at"], whole[:size]),
                    (keys + 8 * part["known"], whole[size : size + words]),
                    (counts + 8 * part["known"], whole[size + words :]),
                ):
                    while len(piece):
                        done = os.pwrite(out, piece, place)
                        place, piece = place + done, piece[done:]
            os.fsync(out)
            os.close(out)
            yield pa.RecordBatch.from_pydict({"parts": [batch.num_rows]})

    rows = model.sparkSession.createDataFrame(parts, "shard long, at long, data_bytes long, known long, types long")
    rows.mapInArrow(copy, "parts long").agg(F.sum("parts")).first()
    return lies, bits, first


#: The filter that this process has mapped, by the path of its file.
_MAPPED: dict[str, Counts] = {}


def _mapped_scores(rows: DataFrame, model: DataFrame, folder: str, way: _Way, data_bytes: int, kind: str) -> DataFrame:
    lies, *blocks = _joined(model, folder, way, data_bytes)
    shared = rows.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if lies.path not in _MAPPED:
            _MAPPED.clear()
            _MAPPED[lies.path] = lies.opened(way, *shared.value)
        yield from _scored(batches, _MAPPED[lies.path], way)

    return rows.mapInArrow(run, f"id {kind}, {_SCORED}")


def _broadcast_scores(rows: DataFrame, model: DataFrame, way: _Way, data_bytes: int, kind: str) -> DataFrame:
    found = (r.asDict() for r in model.drop("tokens").toLocalIterator())
    shared = rows.sparkSession.sparkContext.broadcast(Counts.of(found, way.blocks, way.shards, 0, way.shards, data_bytes, way.types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scored(batches, shared.value, way)

    return rows.mapInArrow(run, f"id {kind}, {_SCORED}")


def _asked(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What stands before each token, and the distinct words and pairs of a chunk, both in the order of their keys."""
    starts = np.cumsum(sizes) - sizes
    before = np.roll(tokens, 1)
    before[starts] = START
    words = np.unique(np.append(tokens, START))
    return before, words[np.argsort(word_keys(words))], np.unique(pair_keys(before, tokens))


def _routed_scores(rows: DataFrame, model: DataFrame, way: _Way, kind: str) -> DataFrame:
    """The same where the filter is too large to broadcast and can't be mapped: chunks of documents ask the shards for what they need.

    Words and pairs go to a shard as one row of each chunk and come back as counts alone: a chunk knows the order in which it
    asked. A shard meets its questions one by one, so a task holds one shard and one question.
    """

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        held, n = [], 0

        def chunk() -> pa.RecordBatch:
            ids = pa.concat_arrays([b for b, _, _ in held])
            tokens, sizes = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": [number],
                    "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    "tokens": [tokens.tobytes()],
                    "sizes": [sizes.astype("<i8").tobytes()],
                }
            )

        for batch in batches:
            if batch.num_rows:
                tokens, _, sizes = tokens_of(batch.column("text"))
                held.append((batch.column("id"), tokens, sizes))
                n += len(tokens)
            if n >= TOGETHER:
                yield chunk()
                held, n, number = [], 0, number + 1
        if held:
            yield chunk()

    chunks = landed(rows.mapInArrow(chunked, f"chunk long, ids array<{kind}>, tokens binary, sizes binary"))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, tokens, sizes in zip(*(batch.column(c).to_pylist() for c in ("chunk", "tokens", "sizes")), strict=True):
                _, words, pairs = _asked(np.frombuffer(tokens, "<u8"), np.frombuffer(sizes, "<i8"))
                for is_word, keys, grams in ((True, word_keys(words), words), (False, pairs, pairs)):
                    shard, (cut,) = _cut(keys, way.shards, grams)
                    n = len(shard)
                    yield pa.RecordBatch.from_pydict({"shard": shard, "chunk": pa.array([chunk] * n, pa.int64()), "is_word": [is_word] * n, "grams": cut})

    questions = chunks.select("chunk", "tokens", "sizes").mapInArrow(asked, "shard long, chunk long, is_word boolean, grams binary")
    # a shard comes before its questions: it has no chunk
    both = model.drop("tokens").unionByName(questions, allowMissingColumns=True)
    both = both.repartition("shard").sortWithinPartitions("shard", F.col("chunk").asc_nulls_first())

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, counts = None, None
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["chunk"] is None or row["shard"] != shard:
                    shard = row["shard"]
                    own = [row] if row["chunk"] is None else []
                    counts = Counts.of(own, way.blocks, way.shards, shard, shard + 1, *((len(own[0]["data"]), own[0]["types"]) if own else (0, 0)))
                if row["chunk"] is not None:
                    grams = np.frombuffer(row["grams"], "<u8")
                    levels = counts.levels(word_keys(grams) if row["is_word"] else grams)
                    exact = counts.exact(grams) if row["is_word"] else levels[:0]
                    out.append((row["chunk"], row["is_word"], shard, levels.astype(np.uint8).tobytes(), exact.astype("<i8").tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["chunk", "is_word", "shard", "levels", "exact"])

    answers = both.mapInArrow(answered, "chunk long, is_word boolean, shard long, levels binary, exact binary")

    def scored(chunk: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        r = chunk.iloc[0]
        tokens, sizes = np.frombuffer(r["tokens"], "<u8"), np.frombuffer(r["sizes"], "<i8")
        before, words, pairs = _asked(tokens, sizes)
        given = given.sort_values("shard")
        of_words, of_pairs = given[given["is_word"]], given[~given["is_word"]]
        keys = np.concatenate([word_keys(words), pairs])
        levels = np.frombuffer(b"".join([*of_words["levels"], *of_pairs["levels"]]), np.uint8).astype(np.int64)
        order, by_word = np.argsort(keys), np.argsort(words)
        keys, levels = keys[order], levels[order]
        words, exact = words[by_word], np.frombuffer(b"".join(of_words["exact"]), "<i8")[by_word]
        columns = _scores(
            tokens, before, sizes, lambda k: levels[np.searchsorted(keys, k)], lambda t: exact[np.searchsorted(words, t)], way.total, way.types
        )
        return pd.DataFrame({"id": list(r["ids"])} | columns)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(scored, f"id {kind}, {_SCORED}")


def _power_of_two(least: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(least, 1))))


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES, shard_bytes: int = SHARD_BYTES, bits: float = BITS,
    mapped: bool | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    Tokens are lower-cased (A-Z) words and an end; a null or empty text has the end alone. ``base_score`` adds one to exact
    word counts; ``score`` mixes pairs and single words from the filter. Rows that repeat an id are scored alike; nothing to
    learn from leaves all counts at zero. Extra columns are ignored. ``mapped`` (if unset: where the shared folder is mounted),
    ``broadcast_bytes`` and ``shard_bytes`` change how the filter travels, not a score; ``bits`` for each entry make false
    answers rare.
    """
    in_batches_of(docs.sparkSession, ROWS, BATCH_BYTES)
    kind = type_of(docs, id_col)
    rows = ids_and_texts(docs, id_col, text_col)
    training = rows.filter(~held_out("id"))
    size = training.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = _power_of_two(size / BLOCK_BYTES)
    shards = min(blocks, _power_of_two(size / shard_bytes))
    folder = shared_folder(docs.sparkSession)
    folder = local_path(folder) if (is_mounted(folder) if mapped is None else mapped) else None
    model = learn(training, shards, blocks, bits, folder)
    total, types, data_bytes = (x or 0 for x in model.agg(*map(F.sum, ("tokens", "types", "data_bytes"))).first())
    way = _Way(blocks, shards, total, types)
    if folder is not None and data_bytes:
        out = _mapped_scores(rows, model, folder, way, data_bytes, kind)
    elif data_bytes + 16 * types + 8 * blocks <= broadcast_bytes:
        out = _broadcast_scores(rows, model, way, data_bytes, kind)
    else:
        out = _routed_scores(rows, model, way, kind)
    return out.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
    )
