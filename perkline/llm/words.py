"""Vectorised word splitting over Arrow string columns (runs inside tasks).

A batch of texts is one byte buffer plus offsets, so words, their hashes and
word n-gram hashes come from a few numpy passes over that buffer instead of a
Python loop per word.  Texts are handled in slices of a MB, so memory
does not follow the batch; a slice always holds whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_HASH_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS = np.ones(1, dtype=np.uint64)


def _lookup(is_word) -> np.ndarray:
    """Byte -> 0 for a separator, else 1 + the byte with A-Z lower-cased."""
    out = np.zeros(256, dtype=np.uint64)
    for b in range(256):
        if is_word(b):
            out[b] = 1 + (b + 32 if 65 <= b <= 90 else b)
    return out


#: words ``[^\x20\x09-\x0D]+``, A-Z lower-cased
NON_SPACE = _lookup(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: the same words, case kept
NON_SPACE_EXACT = np.where(NON_SPACE > 0, np.arange(1, 257, dtype=np.uint64), np.uint64(0))
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text
LETTER_DIGIT = _lookup(lambda b: b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), so that sums of words hash well."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 2 * len(_POWERS), 1 << 12), _BASE, dtype=np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS


class Words:
    """Words of consecutive texts: ``first[i]:first[i + 1]`` are those of
    text ``i``; ``start``/``end`` are byte places in ``buf``."""

    __slots__ = ("buf", "start", "end", "first", "hash", "table")

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.buf, self.table = buf, table
        inside = table[buf] != 0
        starts, ends = inside.copy(), inside.copy()
        if len(buf):
            starts[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cut = offsets[1:-1]
            cut = cut[(cut > 0) & (cut < len(buf))]
            starts[cut] = inside[cut]
            ends[cut - 1] = inside[cut - 1]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.zeros(len(self.start), dtype=np.uint64)
        at, n = 0, len(self.start)
        while at < n:
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + _HASH_BYTES, "right")))
            a, b = int(self.start[at]), int(self.end[to - 1])
            begins = self.start[at:to] - a
            place = np.arange(b - a) - np.repeat(begins, np.diff(np.append(begins, b - a)))
            longest = int((self.end[at:to] - self.start[at:to]).max())
            value = self.table[self.buf[a:b]] * _powers(longest + 1)[np.minimum(place, longest)]
            out[at:to] = np.add.reduceat(value, begins)
            at = to
        return mix(out + (self.end - self.start).astype(np.uint64))

    def text(self, i: int) -> bytes:
        """Word ``i`` as hashed (A-Z lower-cased where the table does so)."""
        return (self.table[self.buf[self.start[i] : self.end[i]]] - np.uint64(1)).astype(np.uint8).tobytes()

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each word on, and whether they all lie
        in one text."""
        size = len(self.hash)
        if size < n:
            return np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=bool)
        total = np.zeros(size - n + 1, dtype=np.uint64)
        for k in range(n):
            total += self.hash[k : size - n + 1 + k] * np.uint64(2 * k * 0x632BE59BD9B4E019 + 1 & (1 << 64) - 1)
        out = np.zeros(size, dtype=np.uint64)
        out[: size - n + 1] = mix(total)
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        whole = np.arange(size) + n <= self.first[1:][text]
        return out, whole


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(row, next row, bytes, offsets)`` of consecutive runs of texts; NULL
    is an empty text.  Offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def split(column: pa.Array, table: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """``(row, next row, Words)`` of consecutive runs of texts."""
    for at, to, buf, offsets in slices(column, limit):
        yield at, to, Words(buf, offsets, table)
