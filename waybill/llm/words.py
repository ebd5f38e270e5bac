"""Words of UTF-8 texts as 64-bit numbers, whole Arrow batches at a time.

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. These bytes never occur inside a longer
UTF-8 sequence, so bytes can be worked on directly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
SLICE_BYTES = 1 << 18

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)[_LOWER] | np.uint64(1)
_ODD = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < length:
        size = 1 << (length - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


class Words:
    """The words of consecutive texts: ``hashes``, byte ``starts`` and ``ends`` within ``data``, and
    ``first``: text i has the words ``first[i]:first[i + 1]`` and the bytes ``offsets[i]:offsets[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        size = len(data)
        inside = _IS_WORD[data]
        before = np.zeros(size, bool)
        before[1:] = inside[:-1]
        after = np.zeros(size, bool)
        after[:-1] = inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < size)]
        before[cuts] = False
        after[cuts - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        powers, inverse = _power_tables(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * powers[:size], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def shingles(self, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all ``size``-word shingles, and ``first`` for them. A text with fewer words
        has one shingle of all its words, a text without words none."""
        counts = np.diff(self.first)
        shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        first = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(shingles, out=first[1:])
        values = np.zeros(first[-1], np.uint64)
        rolled = rolling(self.hashes, size)
        long_enough = np.repeat(counts >= size, shingles)
        source = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], shingles)
        values[long_enough] = rolled[source[long_enough]]
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            values[first[i]] = whole(self.hashes[self.first[i] : self.first[i + 1]])
        return values, first


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes, across text borders too."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total += hashes[i : i + count] * _ODD[i]
    return mix(total)


def whole(hashes: np.ndarray) -> np.uint64:
    """One hash for all of a few words."""
    return mix(np.array([np.uint64(len(hashes))]) + (hashes * _ODD[: len(hashes)]).sum(dtype=np.uint64))[0]


def run_hashes(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the runs of ``length`` words that begin at ``starts``."""
    powers, inverse = _power_tables(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes) * powers[: len(hashes)], out=sums[1:])
    return mix((sums[starts + length] - sums[starts]) * inverse[starts])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of strings; nulls are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, Words]]:
    """(index of the first text, its and the next texts' words), in slices of about ``slice_bytes``."""
    data, offsets = utf8(column)
    begin = 0
    while begin < len(column):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + slice_bytes, "right")) - 1)
        end = min(end, len(column))
        yield begin, Words(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin])
        begin = end
