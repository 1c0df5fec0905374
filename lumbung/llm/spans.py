"""Words and hashes of whole Arrow text columns, without a Python loop over characters.

A text column is one byte buffer with offsets.  All helpers work on that buffer,
so words never cross from one text into the next, and a NULL is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

#: bytes 0x20 and 0x09-0x0D part words; every other byte belongs to one
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each text starts and ends in them."""
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        none = np.zeros(n, np.int64)
        return np.zeros(0, np.uint8), none, none
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4))
    at = at.astype(np.int64)
    text = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    starts, ends = at[:-1], at[1:].copy()
    if column.null_count:
        gone = column.is_null().to_numpy(zero_copy_only=False)
        ends[gone] = starts[gone]
    return text, starts, ends


def slices(starts: np.ndarray, ends: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes, so that the arrays over one run stay in memory.

    A longer text is a run of its own; no text is cut.
    """
    first, size = 0, 0
    for i, length in enumerate((ends - starts).tolist()):
        if i > first and size + length > most:
            yield first, i
            first, size = i, 0
        size += length
    if len(starts) > first:
        yield first, len(starts)


class Run:
    """Some consecutive texts as one byte array; ``starts`` and ``ends`` count from its begin."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        low = int(starts[0]) if len(starts) else 0
        high = max(low, int(ends.max())) if len(ends) else low
        self.text = text[low:high]
        self.starts, self.ends = starts - low, ends - low

    def words(self, apart: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes not in ``apart``, and how many each text has."""
        inside = ~apart[self.text]
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.starts] = True
        edge[self.ends] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:n]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | edge[1:n]
        first, last = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        low, high = np.searchsorted(first, self.starts), np.searchsorted(first, self.ends)
        return first, last, np.maximum(high - low, 0)

    def prefix(self, text: np.ndarray | None = None) -> np.ndarray:
        """Sums of byte times power, from which the hash of any span is one subtraction."""
        text = self.text if text is None else text
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers(len(text))[0][: len(text)], out=sums[1:])
        return sums


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = ((n >> 20) + 1) << 20
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def span_hashes(prefix: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; equal spans have equal hashes wherever they stand."""
    return mix((prefix[last] - prefix[first]) * powers(len(prefix))[1][first])


def mix(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(31))
    value = value * np.uint64(0xBF58476D1CE4E5B9)
    value = value ^ (value >> np.uint64(29))
    return value * np.uint64(0x94D049BB133111EB) ^ (value >> np.uint64(32))


def owners(counts: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(counts)), counts)


def sums_by(counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one for each word) over the words of each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    stop = np.cumsum(counts)
    return total[stop] - total[stop - counts]
