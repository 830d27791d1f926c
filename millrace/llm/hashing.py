"""64-bit hashes of the words of whole texts, computed for a batch of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes hashed together; a longer word gets a block of its own.
BLOCK = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Tables:
    def __init__(self) -> None:
        with np.errstate(over="ignore"):
            self.letters = mix(np.arange(256, dtype=np.uint64)) | np.uint64(1)
        lower = np.arange(256)
        lower[65:91] += 32
        self.letters = self.letters[lower]
        self.blank = np.zeros(256, bool)
        self.blank[[0x20, *range(0x09, 0x0E)]] = True
        self.up, self.down = np.ones(0, np.uint64), np.ones(0, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                for name, odd in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
                    step = np.full(n, odd, np.uint64)
                    step[0] = 1
                    setattr(self, name, np.multiply.accumulate(step))
        return self.up[:n], self.down[:n]


_TABLES = _Tables()


def _block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words of some bytes; the hash ignores the case of A-Z."""
    blank = _TABLES.blank[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = _TABLES.powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLES.letters[data] * up[:-1], dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` (words: no space, no control character from tab to carriage return; A-Z count as
    a-z) one text after the other, and the number of words of each text. Null counts as empty."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    if texts.null_count:
        texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    found: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    with np.errstate(over="ignore"):
        k = 0
        while k < len(texts):
            # as many whole texts as fit a block, with a blank between them
            last = max(k + 1, int(np.searchsorted(offsets, offsets[k] + BLOCK, "right")) - 1)
            if last == k + 1:
                for piece in _pieces(data[offsets[k] : offsets[k + 1]]):
                    hashes, _ = _block(piece)
                    found.append(hashes)
                    counts[k] += len(hashes)
            else:
                own = offsets[k : last + 1] - offsets[k]
                joined = np.insert(data[offsets[k] : offsets[last]], own[1:-1], 0x20)
                hashes, starts = _block(joined)
                found.append(hashes)
                counts[k:last] = np.diff(np.searchsorted(starts, np.append(own[:-1] + np.arange(last - k), len(joined) + 1)))
            k = last
    return np.concatenate(found), counts


def _pieces(data: np.ndarray):
    """A long text in blocks that end at a blank."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):
            blanks = np.flatnonzero(_TABLES.blank[data[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
                break
            end = min(end + BLOCK, len(data))
        yield data[at:end]
        at = end


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries."""
    with np.errstate(over="ignore"):
        out = mix(hashes[: max(0, len(hashes) - n + 1)])
        for k in range(1, n):
            out = mix(out * np.uint64(_ODD) + hashes[k : k + len(out)])
    return out


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct ``n``-word shingles of each text; one of fewer words is a single shingle, one of none has no shingle."""
    out = []
    ends = np.cumsum(counts)
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        own = hashes[end - count : end]
        out.append(np.unique(chain(own, min(n, count))) if count else own)
    return out
