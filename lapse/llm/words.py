"""Words and word shingles of a batch of texts, as numpy arrays.

Texts arrive as Arrow string columns.  Words are maximal runs of bytes other
than space and ``\\x09-\\x0D``; ``A-Z`` are lower-cased.  Every word gets a
64-bit polynomial hash of its bytes, every shingle a 64-bit hash of its word
hashes; sets of shingles are compared by these hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER] | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_SLOTS = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)
BLOCK_BYTES = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        m = max(n, 2 * len(_pow), 1 << 16)
        for name, b in (("_pow", _BASE), ("_inv", _INVERSE)):
            a = np.full(m, np.uint64(b))
            a[0] = 1
            globals()[name] = np.multiply.accumulate(a)
    return _pow, _inv


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    off = np.frombuffer(off, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


class Words:
    """Words of consecutive rows: byte spans, hashes, and each row's range."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = ~between.take(data)
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        start, end = inside.copy(), inside.copy()
        if n:
            start[1:] &= ~inside[:-1] | first[1:n]
            end[:-1] &= ~inside[1:] | first[1:n]
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.row = np.searchsorted(self.start, offsets)  # row r has words row[r]:row[r+1]
        power, inverse = _powers(n + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.multiply(_CODES.take(data), power[:n], out=total[1:])
            np.cumsum(total[1:], out=total[1:])
            self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])

    def counts(self) -> np.ndarray:
        return np.diff(self.row)

    def shingles(self, size: int, bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, ranges) of all word shingles of each row - or of each unit
        of words between ``bounds``.  A unit with fewer words has its whole
        sequence as its one shingle, a unit without words none."""
        bounds = self.row if bounds is None else bounds
        n = np.diff(bounds)
        count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        out = np.zeros(len(n) + 1, np.int64)
        np.cumsum(count, out=out[1:])
        at = np.repeat(bounds[:-1] - out[:-1], count) + np.arange(out[-1])
        stop = np.repeat(bounds[1:], count)
        h = np.zeros(len(at), np.uint64)
        padded = np.concatenate([self.hash, np.zeros(size, np.uint64)])
        with np.errstate(over="ignore"):
            for j in range(size):
                w = padded[at + j]
                w[at + j >= stop] = np.uint64(j + 1)
                h += (w ^ (w >> np.uint64(29))) * _SLOTS[j]
            return mix(h), out


def minima(hashes: np.ndarray, ranges: np.ndarray, functions: int, seed: int) -> np.ndarray:
    """MinHash values, one row a unit (units without shingles are absent):
    the smallest of the shingles' hashes under each of ``functions``
    multiplicative re-orderings."""
    keep = ranges[:-1][np.diff(ranges) > 0]
    mult = np.random.default_rng(seed).integers(1, 2**63, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(keep), functions), np.uint64)
    with np.errstate(over="ignore"):
        for j, m in enumerate(mult):
            x = hashes * m
            x ^= x >> np.uint64(32)
            x *= m
            out[:, j] = np.minimum.reduceat(x, keep) if len(keep) else 0
    return out


def signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def list_column(values: np.ndarray, ranges: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ranges.astype(np.int32)), pa.array(values))
