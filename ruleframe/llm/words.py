"""Words of whole texts as arrays, for functions that run on Arrow batches.

A batch of texts is one byte buffer with offsets. Word boundaries, hashes and windows are computed
on that buffer for all texts of a piece at once; a piece holds about ``PIECE`` bytes, or one text
if that is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 2 << 20
#: Words between white space, and words of letters, digits and non-ASCII characters.
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text stands alone."""
    lengths = np.diff(buffers(batch.column(column))[1])
    total = np.cumsum(lengths)
    first = 0
    while first < batch.num_rows:
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as an empty text."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    count = len(texts)
    if not count:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + count + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of all words; ``word`` says which bytes belong to words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_offsets(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text the number of its first word, and the number of all words at the end."""
    return np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(count: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < count:
        size = max(count, PIECE + PIECE // 8)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            tables.append(np.cumprod(factors, dtype=np.uint64))
        if size > 8 * PIECE:
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from one running sum over the whole buffer."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; one fewer for each word short at the end."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : i + count]
    return mix(out)


def trimmed(run):
    """``run`` over Arrow batches; when its task ends, freed memory goes back to the system, since the Python worker
    stays for the next stage."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return runs


def free_name(columns: list[str], name: str) -> str:
    """``name``, or the first longer one that none of the columns has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
