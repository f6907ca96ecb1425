"""Words of whole text columns as arrays: positions and 64-bit hashes, computed on the bytes of an Arrow batch.

A word is a longest run of characters outside \\x20 and \\x09-\\x0D; these are
single bytes in UTF-8, so bytes can be split without decoding."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums of value times power, from which span_hash takes the hash of any span."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power_tables(len(values))[0][: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span, equal for equal sequences wherever they stand; the length counts too."""
    raw = (prefix[end] - prefix[start]) * _power_tables(len(prefix))[1][start]
    return mix(raw + mix((end - start).astype(np.uint64) + np.uint64(7)))


@dataclass
class Words:
    """Words of some consecutive rows: byte positions, hashes and the row's first word."""

    data: np.ndarray  # bytes
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # words of row i: first[i] to first[i + 1]
    rows: slice  # rows of the batch


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return (np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)), bounds


def split(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and each row's first word, for bytes whose rows lie at bounds."""
    inside = ~_SPACE[data]
    if len(data) == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(bounds), dtype=np.int64)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(start, bounds)


def words(column: pa.Array, lower: bool = False, chunk: int = 1 << 19) -> Iterator[Words]:
    """The words of a text column in chunks of whole rows, about chunk bytes each (one long row may be more)."""
    data, bounds = text_column(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + chunk, side="right")) - 1)
        piece = data[bounds[row] : bounds[stop]]
        if lower:
            piece = LOWER[piece]
        start, end, first = split(piece, bounds[row : stop + 1] - bounds[row])
        yield Words(piece, start, end, span_hash(prefix_hash(_VALUES[piece]), start, end), first, slice(row, stop))
        row = stop
    pa.default_memory_pool().release_unused()


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of width words in one row; fewer words count as one run, no word as none."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    at = np.arange(max(1, n - width + 1))
    return span_hash(prefix_hash(hashes), at, np.minimum(at + width, n))
