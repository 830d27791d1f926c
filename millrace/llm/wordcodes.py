"""Words of whole texts as small integers, worked out for a block of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text split together. Longer texts are split in several blocks.
BLOCK = 1 << 22


class Alphabet:
    """What separates words (``blanks``), and what also ends a piece (``ends``). Bytes from 0x80 on belong to words."""

    def __init__(self, blanks: Iterable[int], ends: Iterable[int] = ()) -> None:
        self.word = np.ones(256, bool)
        self.word[[*blanks, *ends]] = False
        self.end = np.zeros(256, bool)
        self.end[[*ends]] = True
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32


class Codes:
    """Numbers of the words that a task has met, from 0 on, with the 64-bit hash that Spark's ``xxhash64`` gives them."""

    def __init__(self) -> None:
        self.code: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self._hashes = np.zeros(1024, np.uint64)

    def __len__(self) -> int:
        return len(self.words)

    def encode(self, words: pa.Array) -> np.ndarray:
        """The number of each word; new words get the next ones."""
        found = words.dictionary_encode()
        code, known = self.code, self.words
        own = np.empty(len(found.dictionary), np.int64)
        for k, word in enumerate(found.dictionary.to_numpy(zero_copy_only=False).tolist()):
            at = code.get(word)
            if at is None:
                at = code[word] = len(known)
                known.append(word)
            own[k] = at
        return own[found.indices.to_numpy()]

    def hashes(self, done: list[int]) -> np.ndarray:
        """Hashes by number. ``done`` holds how many are there and is kept by the caller between calls."""
        if len(self._hashes) < len(self.words):
            self._hashes = np.concatenate([self._hashes, np.zeros(len(self.words), np.uint64)])
        for k in range(done[0], len(self.words)):
            self._hashes[k] = xxhash.xxh64_intdigest(self.words[k], 42)
        done[0] = len(self.words)
        return self._hashes


def gathered(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in record batches of about ``size`` bytes."""
    some: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        some.append(batch)
        held += batch.nbytes
        if held >= size:
            yield pa.concat_batches(some)
            some, held = [], 0
    if some:
        yield pa.concat_batches(some)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def _split(data: np.ndarray, begins: np.ndarray, alphabet: Alphabet) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of ``data``, where each starts, and whether it starts a piece. A text starts at each of ``begins``."""
    word = alphabet.word[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = word[1:] != word[:-1]
    edge[begins] = True
    at = np.flatnonzero(edge)
    spans = word[at[:-1]]
    starts, ends = at[:-1][spans], at[1:][spans]
    lengths = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=lengths[1:])
    plain = alphabet.lower[data[word]]
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(plain)])
    # a piece starts where a text starts or a piece ends between a word and the one before it
    breaks = alphabet.end[data]
    breaks[begins] = True
    piece = np.cumsum(breaks, dtype=np.int32)[starts]
    first = np.ones(len(starts), bool)
    first[1:] = piece[1:] != piece[:-1]
    return words, starts, first


def coded(texts: pa.Array, alphabet: Alphabet, codes: Codes, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of words: their numbers, whether they start a piece, and the place of their text in ``texts``.

    A-Z count as a-z, null counts as empty. A text longer than a block comes in several, each of which begins with the last
    ``overlap`` words of the one before: every run of ``overlap + 1`` words lies in exactly one of them.
    """
    data, offsets = _bytes(texts)
    k, n = 0, len(texts)
    while k < n:
        last = max(k + 1, int(np.searchsorted(offsets, offsets[k] + BLOCK, "right")) - 1)
        if last > k + 1 or offsets[last] - offsets[k] <= BLOCK:
            own = offsets[k : last + 1] - offsets[k]
            words, starts, first = _split(data[offsets[k] : offsets[last]], own[:-1][own[:-1] < own[-1]], alphabet)
            if len(words):
                yield codes.encode(words), first, k + np.searchsorted(own, starts, "right") - 1
        else:
            at, end, size = int(offsets[k]), int(offsets[k + 1]), BLOCK
            while at < end:
                to = _cut(data, at, min(at + size, end), end, alphabet)
                words, starts, first = _split(data[at:to], np.zeros(1, np.int64), alphabet)
                if to < end and len(words) <= overlap:
                    size *= 2
                    continue
                if len(words):
                    yield codes.encode(words), first, np.full(len(words), k)
                at = at + int(starts[-overlap]) if to < end and overlap else to
                size = BLOCK
        k = last


def _cut(data: np.ndarray, at: int, to: int, end: int, alphabet: Alphabet) -> int:
    """Where a block from ``at`` ends: after a separator, ``to`` or the last one before it, else the next one."""
    if to == end:
        return end
    found = np.flatnonzero(~alphabet.word[data[at:to]])
    if len(found):
        return at + int(found[-1]) + 1
    while to < end:
        more = min(to + BLOCK, end)
        found = np.flatnonzero(~alphabet.word[data[to:more]])
        if len(found):
            return to + int(found[0]) + 1
        to = more
    return end
