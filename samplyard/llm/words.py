"""Words, word hashes and hashes of word runs over many texts at once.

A word is a maximal run of bytes other than space and \\x09-\\x0D of the UTF-8 text, which is the
same as a run of characters other than these. Hashes are 64-bit, equal for equal words in every
process: a polynomial over random byte values, so all words of a buffer come from one running sum.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Longest stretch hashed at once; a stretch ends at a white space unless one word is longer.
STRETCH = 1 << 20

_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """The first ``n`` values of a fixed pseudo-random sequence."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(BASE))


BYTE_VALUES = seeded(256, 1)
RUN_FACTORS = seeded(64, 2) | np.uint64(1)


def _power(base: int, n: int) -> np.ndarray:
    known = _powers[base]
    if len(known) < n:
        grown = np.full(1 << (n - 1).bit_length(), base, np.uint64)
        grown[0] = 1
        known = _powers[base] = np.multiply.accumulate(grown)
    return known


def _stretch(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _power(BASE, len(data))[: len(data)], out=total[1:])
    hashes = (total[ends] - total[starts]) * _power(INVERSE, len(data))[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of the texts ``data[bounds[i]:bounds[i + 1]]``, and for
    each text where its words start in these arrays (one more entry than texts)."""
    found, at = [], 0
    while at < len(data):
        stop = min(at + STRETCH, len(data))
        if stop < len(data):
            near = bounds[np.searchsorted(bounds, stop, "right") - 1]
            if near > at:
                stop = int(near)
            else:
                gaps = np.flatnonzero(SPACE[data[at:stop]])
                while not len(gaps) and stop < len(data):
                    grown = min(len(data), stop + STRETCH)
                    gaps = np.flatnonzero(SPACE[data[stop:grown]]) + (stop - at)
                    stop = grown
                following = bounds[np.searchsorted(bounds, at, "right")]
                stop = min(int(following), at + int(gaps[-1]) + 1 if len(gaps) else stop)
        cuts = bounds[np.searchsorted(bounds, at, "right") : np.searchsorted(bounds, stop)] - at
        starts, ends, hashes = _stretch(data[at:stop], cuts)
        found.append((starts + at, ends + at, hashes))
        at = stop
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    starts, ends, hashes = (np.concatenate(x) for x in zip(*found))
    return starts, ends, hashes, np.searchsorted(starts, bounds)


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` values from each place on; shorter by ``k - 1``."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * RUN_FACTORS[j]
    return mix(total)


def shingles(hashes: np.ndarray, k: int, runs: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct ``k``-word shingles of one text; a shorter text is one shingle, an empty
    one has none. ``runs``: its run hashes, when they are known."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    if len(hashes) < k:
        padded = np.concatenate([hashes, np.full(1, len(hashes), np.uint64)])
        return run_hashes(padded, len(padded))
    return np.unique(run_hashes(hashes, k) if runs is None else runs)
