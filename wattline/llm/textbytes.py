"""Columnar byte helpers shared by the text operators.

A string column is looked at as one UTF-8 byte array plus document bounds;
words, lines and word windows are found with array operations over whole
slices of documents, never document by document. A hash of any byte range
comes from prefix sums of a polynomial over the integers modulo the prime
2**61 - 1 (a power of two as modulus would give words like Thue and Morse's
and their complements one hash), so a slice costs a few passes over its bytes,
taken in runs that fit a cache. Slices hold `SLICE_BYTES` of text
(or one longer document), which bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

# Words are runs of anything but these bytes: space, tab, LF, VT, FF, CR.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_U = np.uint64
_PRIME = (1 << 61) - 1
_P = _U(_PRIME)
_BASE = 0x1337_9E37_79B9_7F4B % _PRIME
_BASE_INVERSE = pow(_BASE, -1, _PRIME)
_RUN = 1 << 14           # bytes whose sums are made at a time
_KEPT_POWERS = (2 * SLICE_BYTES) + 1
_is_sep = np.zeros(256, bool)
_is_sep[list(SEPARATORS)] = True
_byte_values = np.random.default_rng(20240607).integers(1, 2**31, 256, dtype=np.uint64)
_lower_values = _byte_values.copy()
_lower_values[65:91] = _byte_values[97:123]
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x = x * _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """Remainders modulo the prime, of any 64-bit values."""
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of remainders modulo the prime: 2**61 counts as 1, halves keep every product below 2**64."""
    half = _U(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> _U(32), a & half, b >> _U(32), b & half
    low, middle = a0 * b0, a1 * b0 + a0 * b1
    return _reduced(((a1 * b1) << _U(3)) + (middle >> _U(29)) + ((middle & _U(0x1FFFFFFF)) << _U(32))
                    + (low & _P) + (low >> _U(61)))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each; tables of usual slices are kept."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    tables = []
    for base in (_BASE, _BASE_INVERSE):
        table = np.ones(1, _U)
        while len(table) < n:
            table = np.concatenate((table, times(table, np.full(len(table), pow(base, len(table), _PRIME), _U))))
        tables.append(table[:max(n, min(len(table), _KEPT_POWERS))])
    if n <= _KEPT_POWERS:
        _powers = tables
    return tables


def _prefix_sums(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Sums modulo the prime of the first values (below 2**31) times their powers, none of them first."""
    sums = np.zeros(len(values) + 1, _U)
    low31, low30 = _U(0x7FFFFFFF), _U(0x3FFFFFFF)
    for at in range(0, len(values), _RUN):
        v = values[at:at + _RUN]
        p = powers[at:at + len(v)]
        high = v * (p >> _U(30))
        term = v * (p & low30) + (high >> _U(31)) + ((high & low31) << _U(30))
        upper, lower = np.cumsum(term >> _U(31)), np.cumsum(term & low31)
        sums[at + 1:at + 1 + len(v)] = _reduced((upper >> _U(30)) + ((upper & low30) << _U(31)) + lower + sums[at])
    return sums


class Texts:
    """Some documents' texts (null: empty) as bytes, with byte bounds."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
        n = len(column)
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
        base = int(bounds[0])
        size = int(bounds[-1]) - base
        self.data = np.frombuffer(data, np.uint8)[base:base + size] if size else np.zeros(0, np.uint8)
        self.starts = bounds[:-1] - base
        self.ends = bounds[1:] - base

    def __len__(self) -> int:
        return len(self.starts)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """Index of the document that holds each byte position."""
        return np.searchsorted(self.ends, positions, side="right")

    def counts(self, mask: np.ndarray) -> np.ndarray:
        """Number of marked bytes in each document."""
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.ends] - total[self.starts]

    def range_hasher(self, lower: bool = False):
        """Function from byte ranges to 64-bit hashes of their content."""
        powers, inverses = _power_tables(len(self.data) + 1)
        sums = _prefix_sums((_lower_values if lower else _byte_values)[self.data], powers)
        return lambda a, b: mix(times(_reduced(sums[b] + (_P - sums[a])), inverses[a]) + (b - a).astype(_U))

    def words(self, separators: np.ndarray = _is_sep) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every word, and its document's index."""
        inside = ~separators[self.data]
        n = len(inside)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, z
        filled = self.starts < self.ends
        first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        first[self.starts[filled]] = True
        last[self.ends[filled]] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | first[1:n]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | last[1:n]
        a = np.flatnonzero(opens)
        return a, np.flatnonzero(closes) + 1, self.doc_of(a)


def slices(batch: pa.RecordBatch | pa.Table, column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most `limit` text bytes (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    total = np.concatenate(([0], np.cumsum(np.asarray(sizes, dtype=np.int64))))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def windows(hashes: np.ndarray, docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words inside one document, and each run's first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at = np.flatnonzero(docs[:n] == docs[width - 1:])
    out = np.zeros(len(at), _U)
    for k in range(width):
        out = (out ^ hashes[at + k]) * _U(0xD6E8FEB86659FD93) + _U(0x2545F4914F6CDD1D)
        out ^= out >> _U(32)
    return mix(out), at


def group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Index of the first row of each group of equal adjacent keys."""
    n = len(sorted_keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for key in sorted_keys:
            new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
