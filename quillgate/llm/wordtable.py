"""Words of many UTF-8 texts at once: cut in numpy, told apart by exact keys, kept in a hash table of plain arrays.

A word of up to `SHORT` bytes is its own key: two 64-bit numbers that hold its bytes and its length, so equal keys are equal
words. Longer ones are left to the caller. Nothing here makes a Python object for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE, LETTER, DIGIT, MARK = range(4)
#: Kind of each byte: ASCII white space, a-z and all of non-ASCII characters, 0-9, the rest.
KIND = np.full(256, MARK, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[48:58] = DIGIT
KIND[97:123] = KIND[128:] = LETTER
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SHORT = 15
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a string column and where each begins (one more: the end). Null texts are empty."""
    own = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    own = own.cast(pa.large_binary()).fill_null(b"")
    if not len(own):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = own.buffers()
    at = np.frombuffer(offsets, np.int64)[own.offset : own.offset + len(own) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def runs(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about limit bytes that cut no word: each ends before white space or where a text begins."""
    a = 0
    while a < len(data):
        z = min(a + limit, len(data))
        if z < len(data):
            edge = int(offsets[np.searchsorted(offsets, z)])
            while z < edge:
                gap = np.flatnonzero(KIND[data[z : min(z + 4096, edge)]] == SPACE)
                if len(gap):
                    z += int(gap[0])
                    break
                z = min(z + 4096, edge)
        yield a, z
        a = z


def words(kind: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word bounded by white space begins, and its bytes. edges: where texts begin."""
    full = kind != SPACE
    first = full.copy()
    first[1:] &= ~full[:-1]
    edges = edges[edges < len(kind)]
    first[edges] = full[edges]
    last = full.copy()
    last[:-1] &= ~full[1:]
    before = edges[edges > 0] - 1
    last[before] = full[before]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1 - start


def keys(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the keys of words of SHORT bytes at most."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
    n = size.astype(np.int64)
    a = eight[start] & _MASK[np.minimum(n, 8)]
    b = (eight[start + 8] & _MASK[np.maximum(n - 8, 0)]) | (n.astype(np.uint64) << np.uint64(56))
    return a, b


def spelled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words of those keys, one after the other, and their sizes."""
    size = (b >> np.uint64(56)).astype(np.int64)
    each = np.stack([a, b], 1).astype("<u8").view(np.uint8).reshape(len(a), 16)
    return each[np.arange(16) < size[:, None]], size


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct keys the place of one of each; for each key its number among the distinct ones."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class Table:
    """Rows by key, numbered from 1; row 0 stands for no row."""

    def __init__(self, bits: int = 15):
        self.n, self.bits = 0, bits
        self.a, self.b = np.zeros(1 << (bits - 1), np.uint64), np.zeros(1 << (bits - 1), np.uint64)
        self.slots = np.zeros(1 << bits, np.int32)

    def _home(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = (a ^ (b * _B)) * _A
        return (((h ^ (h >> np.uint64(29))) * _B) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at, mask = self._home(a, b), (1 << self.bits) - 1
        row = self.slots[at]
        hit = (self.a[row] == a) & (self.b[row] == b)
        rest = np.flatnonzero(~hit & (row > 0))
        row[~hit] = 0
        while len(rest):
            at[rest] = (at[rest] + 1) & mask
            r = self.slots[at[rest]]
            hit = (self.a[r] == a[rest]) & (self.b[r] == b[rest])
            row[rest[hit]] = r[hit]
            rest = rest[~hit & (r > 0)]
        return row

    def add(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rows of distinct keys that aren't there yet."""
        first = self.n + 1
        self.n += len(a)
        while self.n + 1 > len(self.a):
            self.a, self.b = np.concatenate([self.a, np.zeros_like(self.a)]), np.concatenate([self.b, np.zeros_like(self.b)])
        self.a[first : self.n + 1], self.b[first : self.n + 1] = a, b
        if 2 * self.n > 1 << self.bits:
            while 2 * self.n > 1 << self.bits:
                self.bits += 1
            self.slots = np.zeros(1 << self.bits, np.int32)
            self._place(1)
        else:
            self._place(first)
        return np.arange(first, self.n + 1, dtype=np.int32)

    def _place(self, first: int) -> None:
        rows, mask = np.arange(first, self.n + 1, dtype=np.int32), (1 << self.bits) - 1
        at = self._home(self.a[rows], self.b[rows])
        while len(rows):
            free = self.slots[at] == 0
            self.slots[at[free]] = rows[free]
            left = self.slots[at] != rows
            rows, at = rows[left], (at[left] + 1) & mask

    def cut(self, n: int) -> None:
        """Keeps the first n rows."""
        self.n = min(n, self.n)
        self.slots[:] = 0
        self._place(1)

    def rows_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rows of keys, added where they are new."""
        row = self.find(a, b)
        new = np.flatnonzero(row == 0)
        if len(new):
            one, number = distinct(a[new], b[new])
            row[new] = self.add(a[new][one], b[new][one])[number]
        return row


def put(a: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """a with new from at on, made longer where needed."""
    while at + len(new) > len(a):
        a = np.concatenate([a, np.zeros_like(a)])
    a[at : at + len(new)] = new
    return a
