"""Words of many texts at once, as 64-bit numbers.

A word is a maximal run of characters other than space and U+0009..U+000D; ASCII capitals are
lower-cased. Both are properties of single UTF-8 bytes, so a whole Arrow buffer is cut in a few
numpy passes instead of a Python loop over words. A word's number is a polynomial over random byte
values modulo 2^64, taken from prefix sums and mixed with the word's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # working memory per step; one longer text is a slice of its own
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_rng = np.random.Generator(np.random.PCG64(20240229))
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = _VALUES[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {"n": 0, "up": np.ones(0, np.uint64), "down": np.ones(0, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
        _powers["n"] = n
    return _powers["up"][:n], _powers["down"][:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES each."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in ``data`` and the row that holds it (``offsets`` relative to ``data``).

    ``between`` tells for each byte value whether it lies between words."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~between[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = cuts[cuts > 0] - 1
    ends[tails] = inside[tails]
    stops = np.flatnonzero(ends) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, stops, rows


def hash_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:-1], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def hashed_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, tuple]]:
    """Per slice: first row, last row (exclusive), word numbers, each word's row, (bytes, starts, ends)."""
    data, offsets = buffers(column)
    for first, last in slices(offsets):
        lo, hi = offsets[first], offsets[last]
        part, inner = data[lo:hi], offsets[first : last + 1] - lo
        starts, stops, rows = word_bounds(part, inner)
        yield first, last, hash_spans(part, starts, stops) if len(starts) else np.zeros(0, np.uint64), rows, (part, starts, stops)


def row_ranges(rows: np.ndarray, count: int) -> np.ndarray:
    """Offsets of each row's words in a list sorted by row."""
    return np.searchsorted(rows, np.arange(count + 1))
