"""Hashes of words and of runs of words, for whole Arrow columns at a time (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in blocks of so many bytes, so memory doesn't grow with the batch.
BLOCK_BYTES = 1 << 18
#: Words are hashed so many bytes at a time: each byte takes some fifty while it is hashed.
SECTION_BYTES = 1 << 16
#: Bytes of text in a batch that a task hands on.
SLICE_BYTES = 1 << 21
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values evenly (multiplications and shifts)."""
    x = x.astype(_U, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> _U(shift)
        x *= _U(factor)
    x ^= x >> _U(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets.astype(np.int64) - int(offsets[0])


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def sliced(batches: Iterator[pa.RecordBatch], place: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of at most ``most`` bytes of text (column number ``place``), or of one row."""
    for batch in batches:
        _, offsets = column_bytes(batch.column(place))
        for lo, hi in blocks(offsets, most):
            yield batch.slice(lo, hi - lo)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, ...]:
    """Hash, start and end byte of every word, and the word index at which each row begins (one more at
    the end). Words are cut at blanks and at row borders; ``lower`` takes A-Z as a-z."""
    full = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = full.copy()
    first[1:] &= ~full[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, _U), starts, starts, np.zeros(len(offsets), np.int64)
    last = full.copy()
    last[:-1] &= ~full[1:] | edge[1:-1]
    ends = np.flatnonzero(last) + 1
    length = ends - starts
    table, powers = _LOWER if lower else _BYTE, _powers(int(length.max()))
    h = np.empty(len(starts), _U)
    for lo, hi in blocks(np.append(starts, ends[-1]), SECTION_BYTES):
        part = slice(starts[lo], ends[hi - 1])
        places, own = np.flatnonzero(full[part]), length[lo:hi]
        at = np.cumsum(own) - own
        value = table[data[part][places]] * powers[np.arange(len(places)) - np.repeat(at, own)]
        h[lo:hi] = np.add.reduceat(value, at)
    return mixed(h), starts, ends, np.searchsorted(starts, offsets)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` neighbours, by the index of the first; those over a row border are there too."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j, f in enumerate(_powers(k)):
        out += hashes[j : j + n] * f
    return mixed(out)
