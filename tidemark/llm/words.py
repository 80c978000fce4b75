"""Words and word hashes of whole Arrow text columns, byte-wise and without Python loops over words.

A word is a maximal run of bytes other than space and 0x09-0x0D. UTF-8 keeps those bytes out of
multi-byte characters, so working on bytes is the same as working on characters. Hashes are 64 bits:
a polynomial over random byte values, mixed at the end; the same word has the same hash everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(1, 2**63, dtype=np.uint64)) | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Kinds of bytes: 0 white space, 1 ASCII letter, 2 ASCII digit, 3 other ASCII, 4 part of another character.
BYTE_KIND = np.full(256, 3, dtype=np.uint8)
BYTE_KIND[128:] = 4
BYTE_KIND[48:58] = 2
BYTE_KIND[65:91] = BYTE_KIND[97:123] = 1
BYTE_KIND[_SPACE] = 0
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values; each salt gives another one."""
    with np.errstate(over="ignore"):
        h = h ^ np.uint64(salt * int(_ODD) % 2**64)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(steps)
        _powers[base] = have
    return have[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def _blocks(start: np.ndarray, end: np.ndarray, size: int = 1 << 18) -> list[tuple[int, int]]:
    """Ranges of pieces that cover about size bytes each, so that work stays in the CPU's caches."""
    blocks, lo = [], 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + size, side="right")))
        blocks.append((lo, hi))
        lo = hi
    return blocks


@dataclass
class Spans:
    """Pieces of a text column: bytes [start, end), each belonging to one row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    rows: int

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each piece."""
        out = np.empty(len(self.start), dtype=np.uint64)
        for lo, hi in _blocks(self.start, self.end):
            a, b = int(self.start[lo]), int(self.end[hi - 1])
            start, end = self.start[lo:hi] - a, self.end[lo:hi] - a
            with np.errstate(over="ignore"):
                total = np.zeros(b - a + 1, dtype=np.uint64)
                np.cumsum(_BYTE[self.data[a:b]] * _power(_BASE, b - a), out=total[1:])
                sums = (total[end] - total[start]) * _power(_BASE_INVERSE, b - a + 1)[start]
                out[lo:hi] = mix(sums + (end - start).astype(np.uint64) * _ODD)
        return out

    def texts(self, which: np.ndarray) -> list[bytes]:
        """The bytes of the chosen pieces."""
        whole = memoryview(np.ascontiguousarray(self.data))
        return [bytes(whole[a:b]) for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)]

    def per_row(self) -> np.ndarray:
        """Offsets (rows + 1) of each row's pieces."""
        return np.concatenate([[0], np.cumsum(np.bincount(self.row, minlength=self.rows))])


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at row borders."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    first = first[:n]
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & (~before | first))
    after = np.concatenate([inside[1:], [False]])
    last = np.concatenate([first[1:], [True]])
    return start, np.flatnonzero(inside & (~after | last)) + 1


def words(column: pa.Array, lower: bool = False) -> Spans:
    """The words of each row; lower maps A-Z to a-z first."""
    data, offsets = raw(column)
    if lower:
        data = LOWER[data]
    start, end = _runs(~_SPACE[data], offsets)
    return Spans(data, start, end, np.searchsorted(offsets, start, side="right") - 1, len(column))


def shingles(column: pa.Array, size: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each row as (sorted hashes, offsets).

    With fewer than size words the whole sequence is the one shingle; without words there is none.
    """
    spans = words(column, lower)
    h, at = spans.hashes(), spans.per_row()
    count = np.diff(at)
    made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(spans.rows), made)
    begin = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made) + np.repeat(at[:-1], made)
    have = np.minimum(np.repeat(count, made), size)
    total = np.zeros(len(begin), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            inside = have > k
            total[inside] += mix(h[begin[inside] + k], k + 1)
        total = mix(total + have.astype(np.uint64))
    border = np.concatenate([[0], np.cumsum(made)])
    for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
        total[a:b].sort()
    keep = np.ones(len(total), dtype=bool)
    keep[1:] = (total[1:] != total[:-1]) | (row[1:] != row[:-1])
    return total[keep], np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=spans.rows))])
