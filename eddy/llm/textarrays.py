"""Words and word n-grams of Arrow text batches as numpy arrays.

The operators of this subpackage read whole texts inside Spark tasks.  A
batch's texts are one UTF-8 byte buffer with offsets, so words are found
and hashed for a whole batch with a few array operations.

Words are ``[^\\x20\\x09-\\x0D]+``.  A null text is an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
# Bytes of text handled at once; a longer document is handled alone.
SLICE_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# One odd multiplier per place in an n-gram (n-grams of up to 32 words).
_PLACE = _rng.integers(1, 1 << 63, 32, dtype=np.uint64) * _U(2) + _U(1)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xor-shift and multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string or binary array; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def give_back() -> None:
    """Return the memory that this process has freed.

    Spark keeps Python workers for later tasks, and allocators keep what one
    task freed; several idle workers would so hold an executor's memory.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not the C library that has it
        pass


# Of a group after which memory is given back; small ones leave little.
LARGE_GROUP = 4 << 20


def tidy(group: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A function of groups that gives its memory back after each large one."""
    def run(table):
        try:
            return group(table)
        finally:
            if table.nbytes >= LARGE_GROUP:
                give_back()
    return run


def tidy_pair(group: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for cogroups."""
    def run(left, right):
        try:
            return group(left, right)
        finally:
            if left.nbytes + right.nbytes >= LARGE_GROUP:
                give_back()
    return run


def tidy_batches(batches_of: Callable) -> Callable:
    """A function of Arrow batches that gives its memory back at its task's end."""
    def run(batches):
        try:
            yield from batches_of(batches)
        finally:
            give_back()
    return run


class Words:
    """Words of a run of texts.

    ``starts``/``ends`` are byte places in ``data``; ``first[i]:first[i+1]``
    are the words of text ``i``.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.off = off
        black = ~_SPACE[data]
        before = np.empty_like(black)
        before[1:] = black[:-1]
        after = np.empty_like(black)
        after[:-1] = black[1:]
        filled = off[:-1] < off[1:]
        before[off[:-1][filled]] = False
        after[off[1:][filled] - 1] = False
        self.starts = np.flatnonzero(black & ~before)
        self.ends = np.flatnonzero(black & ~after) + 1
        self.first = np.searchsorted(self.starts, off)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word, over its bytes and length."""
        out = np.empty(len(self.starts), np.uint64)
        for a, b in slices(np.append(self.starts, self.ends[-1:]), SLICE_BYTES):
            at = self.starts[a]
            piece = self.data[at:self.ends[b - 1]]
            power, inverse = _powers(len(piece))
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_BYTE[piece] * power, out=sums[1:])
            s, e = self.starts[a:b] - at, self.ends[a:b] - at
            out[a:b] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
        return mix(out)


_power_table: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse (a slice's worth is kept)."""
    if _power_table and n < len(_power_table[0]):
        power, inverse = _power_table
    else:
        size = max(2 * SLICE_BYTES, n)
        power, inverse = (np.cumprod(np.append(_U(1), np.full(size, x, np.uint64))) for x in (_BASE, _BASE_INV))
        if size == 2 * SLICE_BYTES:
            _power_table[:] = power, inverse
    return power[:n], inverse[:n + 1]


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n``-word windows of one text's word hashes."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    m = len(words) - n + 1
    acc = np.full(m, _U(n), np.uint64)
    for j in range(n):
        acc += words[j:j + m] * _PLACE[j]
    return mix(acc)


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """The sorted distinct ``n``-word shingles of one text.

    A text of fewer words has its whole sequence as its one shingle; a text
    without words has none.
    """
    return np.unique(grams(words, min(n, len(words)))) if len(words) else np.empty(0, np.uint64)


def texts(batch_column: pa.Array, lower: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, word hashes)`` for each text of a column."""
    data, off = utf8(batch_column)
    for a, b in slices(off):
        w = Words(data[off[a]:off[b]], off[a:b + 1] - off[a], lower)
        h = w.hashes()
        for i in range(b - a):
            yield a + i, h[w.first[i]:w.first[i + 1]]
