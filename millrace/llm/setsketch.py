"""SetSketch registers of hashed sets: exponentially spaced, truncated minima.

Every element owns an ascending sequence of points, each assigned to a register drawn on its own; the first point that a
register gets from an element is exponential and independent of the other registers. A register keeps the smallest point
as ``floor(1 - log_b x)``, truncated to ``0..LIMIT``. Registers of a union are the larger ones of its parts. Equal
registers are about as likely as the sets' Jaccard similarity, and which of two is larger tells the rest: the similarity
is estimated from both by likelihood, given the sizes.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.hashing import mix

#: Registers, base, rate and largest value.
REGISTERS = 163
BASE = 1.01
RATE = 20.0
LIMIT = 65_534
BANDS, ROWS = 32, 5
#: Points drawn at once for an element.
MOST_POINTS = 64


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers (unsigned 16 bits) per set of 64-bit hashes."""
    m = REGISTERS
    out = np.zeros((len(sets), m), np.int64)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    if not sizes.sum():
        return out.astype(np.uint16)
    seed = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    x = np.zeros(len(seed))
    done = 0
    with np.errstate(over="ignore"):
        while len(seed):
            # the same points of each element whatever else is in the batch; few at first, as large sets need few
            number = np.arange(done + 1, done + 1 + min(max(done, 1), MOST_POINTS), dtype=np.uint64)
            drawn = mix(seed[:, None] + number * np.uint64(0x632BE59BD9B4E019))
            uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            at = (mix(drawn) % np.uint64(m)).astype(np.int64)
            points = np.cumsum(np.column_stack([x, -np.log(uniform) / (RATE * m)]), 1)[:, 1:]
            value = np.clip(np.floor(1 - np.log(points) / np.log(BASE)), 0, LIMIT).astype(np.int64)
            np.maximum.at(flat, owner[:, None] * m + at, value)
            # later points are larger, so elements below the least register of their set are done
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.repeat(out[owner[first]].min(1), np.diff(np.append(first, len(owner))))
            active = value[:, -1] > least
            x, seed, owner = points[active, -1], seed[active], owner[active]
            done += len(number)
    return out.astype(np.uint16)


def band_hashes(regs: np.ndarray) -> np.ndarray:
    """A hash for each set and band of register values."""
    with np.errstate(over="ignore"):
        out = np.empty((len(regs), BANDS), np.uint64)
        for band in range(BANDS):
            h = np.full(len(regs), band, np.uint64)
            for k in range(ROWS):
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + regs[:, band * ROWS + k].astype(np.uint64))
            out[:, band] = h
    return out.view(np.int64)


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def likely(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, least: float, doubt: float = 14.0) -> np.ndarray:
    """Pairs of register rows whose similarity may be ``least`` or more: the likelihood there is not below the highest one
    by more than ``doubt`` (natural logarithm; five standard deviations)."""
    more = (left > right).sum(1)[:, None]
    less = (left < right).sum(1)[:, None]
    same = left.shape[1] - more - less
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    j = np.append(np.linspace(0, 1, 60), least)[None, :] * np.minimum(u / v, v / u)
    j[:, -1] = np.minimum(least, np.minimum(u / v, v / u)[:, 0])
    p, q = _share(u - v * j), _share(v - u * j)
    tiny = 1e-12
    score = more * np.log(p + tiny) + less * np.log(q + tiny) + same * np.log(np.maximum(1 - p - q, 0) + tiny)
    best = score[:, :-1].argmax(1)
    estimate = np.take_along_axis(j, best[:, None], 1)[:, 0]
    return (estimate >= least) | (score.max(1) - score[:, -1] <= doubt)
