"""Vectorised work on Arrow string columns as UTF-8 bytes.

All word definitions used here are sets of *ASCII* separators, and UTF-8
never uses an ASCII byte inside a longer character, so words can be cut on
bytes.  A slice of rows with at most ``max_bytes`` of text is processed at a
time (one row always fits), which bounds the temporary arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000

_rng = np.random.default_rng(20240607)
#: One random odd 64-bit value per byte; capitals A-Z share their small letter's.
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_CODE[65:91] = BYTE_CODE[97:123]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = [int(x) | 1 for x in _rng.integers(1, 2**63, 64, dtype=np.uint64)]

SPACES = np.ones(256, bool)          # words [^\x20\x09-\x0D]+
SPACES[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.ones(256, bool)           # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False


@dataclass
class Slice:
    """Rows ``lo..hi`` of a batch: their text as one byte array, and where each row starts."""
    lo: int
    hi: int
    data: np.ndarray
    start: np.ndarray                # hi - lo + 1 offsets into data


def string_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    buffers = column.buffers()
    if n == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(column, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    data, offsets = string_parts(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield Slice(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, on uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept while a slice's worth."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1, min(SLICE_BYTES + 1, 2 * n)), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= SLICE_BYTES + 1:
            _POWERS[base] = have
    return have[:n]


@dataclass
class Words:
    start: np.ndarray                # byte offset of each word in the slice
    end: np.ndarray
    first: np.ndarray                # per row: index of its first word; len rows + 1


def words(s: Slice, word_byte: np.ndarray) -> Words:
    inside = word_byte[s.data]
    n = len(inside)
    edge = s.start[:-1][s.start[:-1] < n]          # where rows begin: no word runs across
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        before[edge] = False
        after[edge[edge > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, np.searchsorted(start, s.start))


def word_hashes(s: Slice, w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, A-Z as a-z."""
    return range_hashes(s.data, w.start, w.end)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes ``start .. end`` (end not included) of each range."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * _powers(_BASE, len(data)), out=total[1:])
    return mix((total[end] - total[start]) * _powers(_BASE_INVERSE, len(data) + 1)[start])


def shingle_hashes(w: Words, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, and the row of each.

    A row with fewer words, but not none, has its whole sequence as one."""
    n_words = np.diff(w.first)
    if len(h) >= size:
        code = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            code += h[k:len(h) - size + 1 + k] * np.uint64(_PLACE[k])
    else:
        code = np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(n_words)), np.maximum(n_words - size + 1, 0))
    at = np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(n_words - size + 1, 0)) - np.maximum(n_words - size + 1, 0),
                                         np.maximum(n_words - size + 1, 0)) + w.first[row]
    code = code[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        extra = np.array([(sum(int(h[w.first[r] + k]) * _PLACE[k] for k in range(n_words[r]))
                           + int(n_words[r]) * _PLACE[63]) % 2**64 for r in short], np.uint64)
        row, code = np.concatenate([row, short]), np.concatenate([code, extra])
        order = np.argsort(row, kind="stable")
        row, code = row[order], code[order]
    return mix(code), row


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each row; rows may be empty."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind in "iu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def row_sums_exact(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """As ``row_sums``, each row added on its own (no error from other rows)."""
    out = np.zeros(len(first) - 1, np.float64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[:-1][full])
    return out
