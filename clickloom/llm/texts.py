"""Helpers of the text operators: Arrow columns as numpy arrays, hashed words, bounded memos.

Text is handled as UTF-8 bytes where an operator's words are separated by ASCII white space, so
that a batch is hashed with a few numpy calls and no Python string is made.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa

# Hashes of byte strings are polynomials modulo 2**64; the multiplier is odd and so has an inverse.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 1 << 18
_powers: dict[int, np.ndarray] = {}

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(_STEP, 1 << (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[base] = have = np.cumprod(steps, dtype=np.uint64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes together; a longer row is a range of its own."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and for each row where its words begin."""
    inside = ~SEPARATOR[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; equal bytes have equal hashes. Spans are in order and disjoint."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _STEP, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        terms = (data[low:high].astype(np.uint64) + np.uint64(1)) * _powers_of(_BASE, high - low)[: high - low]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        h = (sums[e] - sums[s]) * _powers_of(_INVERSE, high - low)[s]
        out[i:j] = mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` consecutive values (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, width, done = None, 1, 0
    part, factor = h, np.uint64(_BASE)
    # The polynomial over k values is put together from those over 1, 2, 4, ... values.
    while True:
        if k & width:
            piece = part[done : done + n]
            total = piece.copy() if total is None else total * np.uint64(pow(_BASE, width, 1 << 64)) + piece
            done += width
        if width * 2 > k:
            return mix(total)
        part = part[: len(part) - width] * factor + part[width:]
        width *= 2
        factor = np.uint64(pow(_BASE, width, 1 << 64))


def give_back() -> None:
    """Return freed memory to the system. A Python worker waits for its next task with what it has
    taken, beside the executor that then needs it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Memo(dict):
    """Keeps results of ``make`` by key, and starts anew when it holds ``limit`` of them."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value
