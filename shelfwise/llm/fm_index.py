"""A compressed index of integer texts: Burrows-Wheeler transform in a wavelet matrix, searched backwards.

Every step works on many patterns at once with numpy: ranks are popcounts of
packed bits plus block counts.
"""

from __future__ import annotations

import numpy as np

from shelfwise.llm.store import by_value


class Bits:
    """Packed bits with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each position."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Rank of any symbol in a sequence over 0 .. sigma - 1."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.levels = []
        rest = sequence
        for level in reversed(range(max(1, int(sigma - 1).bit_length()))):
            bit = ((rest >> level) & 1).astype(bool)
            self.levels.append((level, Bits(bit), int(len(bit) - bit.sum())))
            rest = np.concatenate([rest[~bit], rest[bit]])
        self.origin = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at``."""
        return self._down(symbol, at) - self.origin[symbol]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` sorted by their first ``depth`` symbols or more, by doubling."""
    rank = text.astype(np.int64)
    size = 1
    while True:
        following = np.zeros(len(rank), np.int64)
        following[: len(rank) - size] = rank[size:] + 1
        key = rank * (int(following.max(initial=0)) + 1) + following
        order = np.argsort(key, kind="stable")
        new = np.zeros(len(rank), np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank, size = new, size * 2
        if size >= depth or size >= len(rank) or rank.max(initial=0) == len(rank) - 1:
            return order


class FMIndex:
    """Index of a text over 1 .. sigma - 1 (0 ends a part); finds patterns of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        text = np.append(text, 0)
        order = suffix_order(text, depth)
        self.wavelet = WaveletMatrix(text[order - 1], sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.size = len(text)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front; empty where high <= low."""
        ranks = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        start, n = self.first[symbol], len(symbol)
        return start + ranks[:n], start + ranks[n:]


def matching_windows(index: FMIndex, text: np.ndarray, start: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last matching window of each streamed part (-1 where none).

    Part i has ``windows[i]`` windows of ``length`` symbols from
    ``start[i]``; symbols below 0 are not in the index.  Matching statistics
    are taken backwards from a window's end, up to ``length``: where the
    match ends early at j, no window holding j matches, and the search goes
    on right of j (first match) or one window left (last match).
    """
    n = len(start)
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)

    def search(todo, window, forward, found):
        """Runs all searches in step until every part has its answer."""
        at = start[todo] + window + length
        low, high = np.zeros(len(todo), np.int64), np.full(len(todo), index.size, np.int64)
        while len(todo):
            at = at - 1
            symbol = text[at]
            known = symbol >= 0
            low, high = low.copy(), high.copy()
            if known.any():
                low[known], high[known] = index.extend(symbol[known], low[known], high[known])
            missed = ~known | (high <= low)
            done = ~missed & (at == start[todo] + window)
            found[todo[done]] = window[done]
            # a miss at j rules out the windows that hold j
            window = np.where(missed, at - start[todo] + 1 if forward else window - 1, window)
            at = np.where(missed, start[todo] + window + length, at)
            low = np.where(missed, 0, low)
            high = np.where(missed, index.size, high)
            more = ~done & ((window < windows[todo]) if forward else (window >= 0))
            todo, window, at, low, high = todo[more], window[more], at[more], low[more], high[more]

    search(np.arange(n), np.zeros(n, np.int64), True, first)
    some = np.flatnonzero(first >= 0)
    search(some, windows[some] - 1, False, last)
    return first, last


by_value(__name__)
