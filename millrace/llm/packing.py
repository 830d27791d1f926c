"""Hierarchical packing of documents into token sequences of several context sizes.

A document's whole windows of the longest size become sequences of their own. What is left goes to the smallest tier it fits
into. Each tier opens a window with one of its own pieces and fills the gap from shorter tiers, whole pieces first, the last
one cut to fit. Every sequence of a tier is full. What remains at the end of a partition is laid end to end into the
longest sizes that it fills, down to the powers of two of the last few tokens. Sequences of one tier form step groups of
equal tokens, dealt out so that the groups' attention costs are near each other.

Partitions are packed on their own, with bounded buffers: no shuffle, no group, nothing on the driver.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.chunks import ChunkEncoder
from millrace.llm.common import ids_and_texts, in_batches_of, type_of

TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Pieces that wait in a tier before windows are opened, tokens of a step group, groups balanced together.
WAITING = 64
GROUP_TOKENS = 16_384
GROUPS = 8
ROWS = 512

Piece = tuple[object, int, bytes, int]  # document, its tokens before the piece, ids, tokens of the document


class Packer:
    """Pieces in, full sequences out: (tier, pieces)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, width: int = 4, waiting: int = WAITING) -> None:
        self.tiers, self.width, self.waiting = tuple(sorted(tiers)), width, waiting
        self.pools: dict[int, deque[Piece]] = {t: deque() for t in self.tiers}
        self.held = dict.fromkeys(self.tiers, 0)

    def _length(self, piece: Piece) -> int:
        return len(piece[2]) // self.width

    def _cut(self, piece: Piece, n: int) -> tuple[Piece, Piece]:
        doc, start, ids, total = piece
        return (doc, start, ids[: n * self.width], total), (doc, start + n, ids[n * self.width :], total)

    def _put(self, piece: Piece, front: bool = False) -> None:
        n = self._length(piece)
        tier = next(t for t in self.tiers if n <= t)
        (self.pools[tier].appendleft if front else self.pools[tier].append)(piece)
        self.held[tier] += n

    def _take(self, tier: int) -> Piece:
        piece = self.pools[tier].popleft()
        self.held[tier] -= self._length(piece)
        return piece

    def _fill(self, gap: int, tiers: list[int]) -> list[Piece]:
        """Exactly ``gap`` tokens from ``tiers``, which hold as many."""
        out = []
        while gap:
            whole = next((t for t in tiers if self.pools[t] and self._length(self.pools[t][0]) <= gap), None)
            piece = self._take(whole if whole is not None else next(t for t in tiers if self.pools[t]))
            if whole is None:
                piece, rest = self._cut(piece, gap)
                self._put(rest, front=True)
            out.append(piece)
            gap -= self._length(piece)
        return out

    def add(self, piece: Piece) -> Iterator[tuple[int, list[Piece]]]:
        longest = self.tiers[-1]
        while self._length(piece) >= longest:
            head, piece = self._cut(piece, longest)
            yield longest, [head]
        if piece[2]:
            self._put(piece)
        for k in range(len(self.tiers) - 1, -1, -1):
            tier = self.tiers[k]
            while len(self.pools[tier]) > self.waiting * (4 if k == 0 else 1):
                below = list(self.tiers[:k][::-1])
                gap = tier - self._length(self.pools[tier][0])
                if sum(self.held[t] for t in below) < gap:  # too few short ones: the tier's own pieces are cut
                    below = [tier]
                    if self.held[tier] < tier:
                        break
                yield tier, [self._take(tier), *self._fill(gap, below)]

    def finish(self) -> Iterator[tuple[int, list[Piece]]]:
        left = sum(self.held.values())
        order = list(self.tiers[::-1])
        while left:
            size = self.tiers[-1]
            while size > left:
                size //= 2
            yield size, self._fill(size, order)
            left -= size


class Groups:
    """Sequences of one tier dealt to step groups in snake order of their attention cost."""

    def __init__(self, tier: int, width: int, tokens: int = GROUP_TOKENS, groups: int = GROUPS) -> None:
        self.each, self.groups, self.width = max(1, tokens // tier), groups, width
        self.waiting: list[list[Piece]] = []

    def add(self, pieces: list[Piece]) -> list[tuple[int, list[Piece]]]:
        """Nothing yet, or the sequences of a full round with their group's number within the round."""
        self.waiting.append(pieces)
        return self.deal() if len(self.waiting) >= self.each * self.groups else []

    def deal(self) -> list[tuple[int, list[Piece]]]:
        ranked = sorted(self.waiting, key=lambda s: -sum((len(p[2]) // self.width) ** 2 for p in s))
        self.waiting = []
        n = -(-len(ranked) // self.each)
        return [((k % n) if k // n % 2 == 0 else n - 1 - k % n, s) for k, s in enumerate(ranked)]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    A document's tokens are its ids and ``end_id``; a null or empty text has the end id alone. Rows that repeat an id, or have
    none, are packed as documents of their own. No rows give no pieces. Extra columns are ignored. ``tiers`` are powers of two.
    """
    if any(t & (t - 1) or t < 1 for t in tiers):
        raise ValueError("context sizes have to be powers of two")
    in_batches_of(docs.sparkSession, ROWS)
    rows = ids_and_texts(docs, id_col, text_col)
    kind = type_of(docs, id_col)
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        encoder = ChunkEncoder.get(tokenizer)
        width = encoder.dtype.itemsize
        end = np.array([end_id], encoder.dtype).tobytes()
        packer = Packer(tiers, width)
        groups: dict[int, Groups] = {}
        out: list[tuple] = []
        sequence = group = 0
        id_kind = None

        def put(tier: int, dealt: list[tuple[int, list[Piece]]]) -> None:
            nonlocal sequence, group
            for g, pieces in dealt:
                offset = 0
                for doc, start, ids, total in pieces:
                    n = len(ids) // width
                    out.append((doc, start, n, zlib.crc32(ids), total, base + sequence, offset, tier, base + group + g))
                    offset += n
                sequence += 1
            group += max((g for g, _ in dealt), default=-1) + 1

        def batch() -> pa.RecordBatch:
            arrays = [pa.array(c, id_kind if k == 0 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for given in batches:
            id_kind = given.schema.field("id").type
            found = encoder.encode(given.column("text"))
            for doc, ids in zip(given.column("id").to_pylist(), found, strict=True):
                total = len(ids) // width + 1
                for tier, pieces in packer.add((doc, 0, ids + end, total)):
                    put(tier, groups.setdefault(tier, Groups(tier, width)).add(pieces))
            if out:
                yield batch()
        for tier, pieces in packer.finish():
            put(tier, groups.setdefault(tier, Groups(tier, width)).add(pieces))
        for tier in sorted(groups):
            put(tier, groups[tier].deal())
        if out:
            yield batch()

    longs = ", ".join(f"{n} long" for n in names[1:])
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {longs}")
