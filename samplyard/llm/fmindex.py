"""A compressed full-text index over word tokens: backward search over a wavelet tree."""

from __future__ import annotations

import numpy as np

#: Tokens by which suffixes are sorted; patterns may be as long.
SORTED = 16


class WaveletTree:
    """How often a symbol stands before a place, for many symbols and places at once.

    One packed bit vector for each bit of a symbol, highest first, zeros of a level before its ones
    on the next; ones are counted from a running count for each 64-bit word and the bits before.
    """

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = []
        self.bits = max(1, int(size - 1).bit_length())
        rows = symbols.astype(np.uint32)
        for level in range(self.bits - 1, -1, -1):
            bit = ((rows >> np.uint32(level)) & np.uint32(1)).astype(bool)
            packed = np.packbits(np.concatenate([bit, np.zeros(-len(bit) % 64 + 64, bool)]), bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32)
            self.levels.append((packed, before, len(bit) - int(np.count_nonzero(bit))))
            rows = np.concatenate([rows[~bit], rows[bit]])
        self.first = self._follow(np.arange(size), np.zeros(size, np.int64))

    def _follow(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, (packed, before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            word = places >> 6
            mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(packed[word] & mask)
            places = np.where((symbols >> level) & 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self._follow(symbols, places) - self.first[symbols]


def sorted_suffixes(tokens: np.ndarray, depth: int = SORTED) -> np.ndarray:
    """Places ordered by their next ``depth`` tokens (a power of two), ties by place."""
    n = len(tokens)
    rank = tokens.astype(np.int64)
    width = 1
    while width < depth:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        pair = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(pair, kind="stable")
        new = np.diff(pair[order], prepend=-1) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        width *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Index of a token text; tokens are whole numbers from 1, 0 separates documents."""

    def __init__(self, tokens: np.ndarray):
        self.size = int(tokens.max(initial=0)) + 1
        self.places = sorted_suffixes(tokens)
        self.tree = WaveletTree(tokens[self.places - 1], self.size)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(tokens, minlength=self.size))])

    def search(self, tokens: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that begin with ``tokens[start:start + length]``, for each start.

        Matching goes backward from the last token. A pattern whose interval has one suffix left is
        not followed further: its interval of one is returned as it is.
        """
        last = tokens[starts + length - 1]
        low, high = self.start[last].copy(), self.start[last + 1].copy()
        todo = np.flatnonzero(high - low > 1)
        for j in range(length - 2, -1, -1):
            symbol = tokens[starts[todo] + j]
            both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low[todo], high[todo]]))
            low[todo] = self.start[symbol] + both[: len(todo)]
            high[todo] = self.start[symbol] + both[len(todo) :]
            todo = todo[high[todo] - low[todo] > 1]
            if not len(todo):
                break
        return low, high


def least_per_window(segments: list[np.ndarray], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """For each window of ``length`` tokens of each segment, the least owner of any segment that has
    the same window. ``segments``: word hashes; each has ``length`` at least."""
    sizes = np.array([len(s) for s in segments], np.int64)
    every = np.concatenate(segments)
    _, symbols = np.unique(every, return_inverse=True)
    # A separator after each segment.
    places = np.arange(len(every)) + np.repeat(np.arange(len(segments)), sizes)
    tokens = np.zeros(len(every) + len(segments), np.int64)
    tokens[places] = symbols + 1
    owner = np.repeat(owners, sizes + 1)
    index = FMIndex(tokens)
    counts = sizes - length + 1
    segment_start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(segment_start, counts) + offsets
    found = np.repeat(owners, counts)
    for at in range(0, len(starts), 1 << 18):
        part = starts[at : at + (1 << 18)]
        low, high = index.search(tokens, part, length)
        many = np.flatnonzero(high - low > 1)
        if not len(many):
            continue
        first, back = np.unique(low[many], return_inverse=True)
        last = np.zeros(len(first), np.int64)
        last[back] = high[many]
        found[at + many] = _least_between(owner[index.places], first, last)[back]
    return np.split(found, np.cumsum(counts)[:-1])


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least value of each interval; intervals are disjoint and ascending."""
    edges = np.column_stack([low, high]).ravel()
    if edges[-1] == len(values):
        edges = edges[:-1]
    return np.minimum.reduceat(values, edges)[::2]
