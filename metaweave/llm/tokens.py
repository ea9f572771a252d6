"""Words of UTF-8 texts as numpy arrays: boundaries, 64-bit hashes and hashes of word windows.

A word is a maximal run of bytes outside ``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F`` after A-Z
are lower-cased: ASCII digits and letters and every non-ASCII character.  Whole batches are
hashed at once; nothing here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is one chunk of its own.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_M1, _M2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may span bytes
        valid = np.asarray(column.is_valid())
        if (np.diff(offsets)[~valid] != 0).any():
            column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
            return utf8(column)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes together, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_M1)
    h ^= h >> np.uint64(33)
    h *= np.uint64(_M2)
    h ^= h >> np.uint64(33)
    return h


def word_bytes() -> np.ndarray:
    """For each byte its lower-cased word byte, 0 if it separates words."""
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low:high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


class Tokenizer:
    """Splits chunks of texts into hashed words; keeps the powers of the hash base between chunks."""

    def __init__(self):
        self.table = word_bytes()
        self.power = self.inverse = np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            def powers(base):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                return np.cumprod(steps)
            self.power = powers(_BASE)
            self.inverse = powers(pow(_BASE, -1, 1 << 64))

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """``(low, starts, ends, hashes, first)``: the lower-cased bytes, word boundaries in them, word hashes,
        and for each text (and the end) the index of its first word."""
        low = self.table[data]
        n = len(low)
        if n == 0:
            empty = np.zeros(0, np.int64)
            return low, empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        inside = low != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edge = offsets[:-1][np.diff(offsets) > 0]
        begins[edge] = inside[edge]  # words end with their text
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        last = edge[edge > 0] - 1
        stops[last] = inside[last]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self._powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        return low, starts, ends, hashes, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (over the whole array, text ends included)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total *= np.uint64(_BASE)
        total += hashes[j:j + n]
    return mix(total + np.uint64(size))


def starts_within(first: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of the ``total - size + 1`` windows lie inside one text; ``first`` as returned by ``Tokenizer.words``."""
    n = total - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(n, bool)
    for back in range(1, size):  # a window that begins fewer than size words before a text's end runs over it
        at = first[1:-1] - back
        ok[at[(at >= 0) & (at < n)]] = False
    # A text of fewer words than ``back`` marks windows of the text before it, which run over as well.
    return ok
