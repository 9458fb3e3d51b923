"""Sampled suffixes of byte strings, and digests of stretches of them, by numpy over many texts at once.

Every window of WIDTH bytes contains exactly one *anchor*: the start of its leftmost stretch of KEY bytes with the least
hash.  Equal windows have their anchor at the same place, wherever they occur, so suffixes need comparing at anchors only.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import mix64
from tidemark.llm.shingles import _CODES, BLOCK

WIDTH = 200
KEY = 100
STEP = 1 << 19  # window starts worked at once
_PLACE = np.uint64((1 << 24) - 1)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(base: int, size: int) -> np.ndarray:
    """base^0 .. base^(size-1) modulo 2^64."""
    out = np.ones(1, np.uint64)
    step = base
    while out.size < size:
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step & 0xFFFFFFFFFFFFFFFF
    return out[:size]


_POWER: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    key = max(BLOCK, 1 << (size - 1).bit_length())
    if key not in _POWER:
        _POWER.clear()
        _POWER[key] = (_powers(_BASE, key), _powers(_INVERSE, key))
    return _POWER[key]


class Digests:
    """Digests of any stretch of a byte array."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(raw.size + 1)
        self.sums = np.zeros(raw.size + 1, np.uint64)
        np.cumsum(_CODES[raw] * up[: raw.size], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts] ^ (ends - starts).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """Digest of the stretch of ``size`` bytes at each start."""
        n = self.sums.size - size
        return mix64((self.sums[size:] - self.sums[:n]) * self.down[:n] ^ np.uint64(size))


def least_of_windows(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` neighbours, by doubling."""
    span = 1
    while 2 * span <= size:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: values.size - (size - span)], values[size - span :]) if size > span else values


def anchors(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the texts that lie side by side in ``raw``, and the first and last window start each stands for."""
    valid = np.ones(raw.size, bool)
    for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
        valid[max(a, b - WIDTH + 1) : b] = False
    found, firsts, lasts = [], [], []
    for at in range(0, max(0, raw.size - WIDTH + 1), STEP):
        upto = min(raw.size - WIDTH + 1, at + STEP)
        part = raw[at : upto + WIDTH - 1]
        hashes = Digests(part).every(KEY)
        keys = hashes & ~_PLACE | np.arange(hashes.size, dtype=np.uint64)
        place = (least_of_windows(keys, WIDTH - KEY + 1) & _PLACE).astype(np.int64)
        starts = np.flatnonzero(valid[at:upto])
        if not starts.size:
            continue
        place = place[starts]
        new = np.flatnonzero(np.diff(place, prepend=-1))
        found.append(place[new] + at)
        firsts.append(starts[new] + at)
        lasts.append(starts[np.append(new[1:], starts.size) - 1] + at)
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    a, f, e = map(np.concatenate, (found, firsts, lasts))
    # An anchor that steps cut apart is one.
    new = np.flatnonzero(np.diff(a, prepend=-1))
    return a[new], f[new], e[np.append(new[1:], a.size) - 1]
