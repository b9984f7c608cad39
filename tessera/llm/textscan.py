"""Vectorised byte-level scanning of Arrow text batches, shared by the operators.

A text column arrives from ``mapInArrow`` as one contiguous UTF-8 buffer with offsets. The functions here work on
that buffer as a numpy array, so the cost is a few passes over the bytes and there is no per-document Python loop.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once. One longer document forms a slice of its own; nothing is cut.
SLICE_BYTES = 500_000

_U = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Lower-cases A-Z only, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def release() -> None:
    """Give free memory back to the system. Python workers outlive their tasks, several to an executor, and the C library
    would keep what their arrays once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a task; free memory is given back when it is done."""

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        release()

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer with full avalanche (splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, 0..n-1."""
    if len(_powers[0]) < n:
        n = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_MULT, pow(_MULT, -1, 1 << 64))):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            _powers[k] = np.cumprod(step, dtype=np.uint64)
    return _powers[0], _powers[1]


def slices(texts: pa.Array, limit: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of whole documents. A null counts as empty."""
    limit = limit or SLICE_BYTES
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    n = len(texts)
    if not n:
        return
    _, ofs, data = texts.buffers()
    size = np.dtype(kind).itemsize
    offsets = np.frombuffer(ofs, kind, n + 1, texts.offset * size).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if texts.null_count:  # a null may own bytes, in theory
        valid = texts.is_valid().to_numpy(zero_copy_only=False)
        if (np.diff(offsets)[~valid] > 0).any():
            yield from slices(texts.fill_null(""), limit)
            return
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (bytes) of each maximal run of word bytes, runs never crossing documents, and its document."""
    n = len(is_word)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    starts = is_word.copy()
    starts[1:] &= ~is_word[:-1]
    inner = offsets[:-1]
    inner = inner[inner < n]
    starts[inner] = is_word[inner]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:]
    last = offsets[1:] - 1
    last = last[last >= 0]
    ends[last] = is_word[last]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offsets, s, "right") - 1


def white_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the words between the white space characters 0x20 and 0x09 to 0x0D."""
    return spans(~_WHITE[data], offsets)


def span_hash(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, wherever it lies: a polynomial over random byte codes, then mixed."""
    up, down = _power(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_TABLE[data] * up[:len(data)], out=total[1:])
    return mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))


def counts_per_doc(doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, minlength=n).astype(np.int64)


def long_array(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list<int64> array from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat))
