"""Words and shingles of whole Arrow batches as numpy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D; in UTF-8
these six bytes never occur inside a longer character, so working on bytes
gives the same words as working on characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shelfwise.llm.store import by_value

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

#: Bytes of text worked on at once; a single longer text is taken whole.
CHUNK = 4 << 20
#: Bytes whose positional powers are held at once.
PIECE = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multiplications."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``start, start + 1, ...`` of the given lengths, one after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (ends - counts), counts)


def slices(batches, column: str, most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds about ``most`` bytes of ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Word bounds of a column: ``start``/``end`` in ``data``, ``first[i]:first[i + 1]`` are the words of row i."""

    def __init__(self, column: pa.Array, fold: bool = False):
        data, offsets = raw(column)
        self.data = FOLD[data] if fold else data
        inner = ~SPACE[data]
        opens, closes = inner.copy(), inner.copy()
        opens[1:] &= ~inner[:-1]
        closes[:-1] &= ~inner[1:]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        opens[edge] = inner[edge]
        closes[edge - 1] = inner[edge - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.offsets = offsets

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        out = np.zeros(len(self.start), np.uint64)
        at, n = 0, len(self.start)
        power = unpower = np.zeros(0, np.uint64)
        while at < n:
            origin = self.start[at]
            end = max(at + 1, int(np.searchsorted(self.end, origin + PIECE, "right")))
            stop = self.end[end - 1]
            size = int(stop - origin)
            if size > len(power):
                power = np.cumprod(np.full(max(size, min(PIECE, len(self.data))), BASE))
                unpower = np.cumprod(np.full(len(power), UNBASE))
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum((self.data[origin:stop].astype(np.uint64) + np.uint64(1)) * power[:size], out=sums[1:])
            s, e = self.start[at:end] - origin, self.end[at:end] - origin
            out[at:end] = (sums[e] - sums[s]) * unpower[s]
            at = end
        return mix(out ^ mix((self.end - self.start).astype(np.uint64)))

    def shingles(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words, and how many each row has."""
        count = np.maximum(self.count - width + 1, 0)
        at = spread(self.first[:-1], count)
        return rolled(hashes, at, width), count


def rolled(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``width`` consecutive word hashes from each position of ``at``."""
    total = np.full(len(at), np.uint64(width))
    for j in range(width):
        total = total * BASE + hashes[at + j]
    return mix(total)


def rows_of(count: np.ndarray) -> np.ndarray:
    """The row of each element, for rows with ``count`` elements."""
    return np.repeat(np.arange(len(count)), count)


by_value(__name__)
