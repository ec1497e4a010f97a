"""Words and hashes of whole texts in numpy, shared by the operators of this folder.

Texts come as Arrow columns and are worked on as bytes of UTF-8: every separator used here is ASCII, so a byte above 127
always belongs to a word. ``pieces`` cuts a batch into runs of rows of a few MB, which bounds the memory of a task; only
a single longer text makes a longer piece.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20
#: Bytes whose words are hashed at a time: the powers kept for that have this length.
WORD_BYTES = 1 << 18

#: Bytes between words: space, and tab to carriage return.
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True

_GENERATOR = np.random.default_rng(20240229)
_BYTE = _GENERATOR.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Code of a byte; the second one reads A-Z as a-z.
EXACT = _BYTE.copy()
LOWERED = _BYTE.copy()
LOWERED[65:91] = LOWERED[97:123]

_STEP = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the step and of its inverse modulo 2^64, at least n of each."""
    if len(_POWERS[0]) >= n:
        return _POWERS
    found = []
    for base in (_STEP, pow(_STEP, -1, 1 << 64)):
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        found.append(np.cumprod(steps, dtype=np.uint64))
    if n <= WORD_BYTES + 1:  # those of one very long word are not kept
        _POWERS[:] = found
    return found


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one entry more than rows). Null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return memory that Arrow and the C allocator hold without use: Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes; behind the last one memory is given back."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(sizes + 8) - 1) // limit
    cuts = np.flatnonzero(np.diff(run)) + 1
    low = 0
    for high in [*cuts.tolist(), batch.num_rows]:
        yield batch.slice(low, high - low)
        low = high
    give_back()


def words(data: np.ndarray, offsets: np.ndarray, blanks: np.ndarray = BLANKS):
    """Start and end of each word, and where the words of each text begin (one entry more than texts)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~blanks[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray, code: np.ndarray = EXACT) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + WORD_BYTES, "right")))
        base = start[i]
        part = data[base : end[j - 1]]
        power, inverse = _powers(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(code[part] * power[: len(part)], out=sums[1:])
        out[i:j] = (sums[end[i:j] - base] - sums[start[i:j] - base]) * inverse[start[i:j] - base]
        i = j
    return mix(out)


def chains(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` words from each word on; those that reach past the last word are cut off."""
    n = max(0, len(codes) - length + 1)
    out = np.zeros(n, np.uint64)
    factor = 1
    for j in range(length):
        out += codes[j : j + n] * np.uint64(factor)
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
    return mix(out + np.uint64(length))


def owners(first: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def longs(column: pa.Array, missing: int) -> np.ndarray:
    """A column of ids as 64-bit integers."""
    return pc.fill_null(column.cast(pa.int64()), missing).to_numpy(zero_copy_only=False)


def binaries(parts: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column: row i holds the bytes of ``parts[cuts[i]:cuts[i + 1]]``."""
    parts = np.ascontiguousarray(parts)
    offsets = (cuts * parts.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(parts)])
