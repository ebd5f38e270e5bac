"""Periodic runs of words, found by block convolution.

A run is a stretch of words that repeats with its smallest period at least three times over, and that
no neighbouring word extends. At each dyadic scale the text is cut into blocks. A number-theoretic
transform gives, for every block and every shift within the scale's distances, the sum of squared
differences to the words there, in exact integers modulo a prime: where it is zero the block stands
there again. The distance is a period to try, and the place is extended both ways.

Scale ``B`` finds all periods q with B <= q < 2 B: a run is at least 3 q long, so that its first
L - q >= 2 q >= 2 B words hold a whole block, whose next copy is q further on. The first scale finds
all periods below 16 in the same way, as a run has 24 words at least.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from waybill.llm.frames import by_batch, texts_of

SHORTEST, REPEATS = 24, 3
FIRST_BLOCK = 8
SLICE_BYTES = 1 << 21
CHUNK = 1 << 19  # numbers transformed at once

# 15 * 2**27 + 1, with 31 a generator of its multiplicative group.
PRIME, GENERATOR, TWOS = 2013265921, 31, 27
_P = np.uint64(PRIME)
_BASES = (1_234_567_891, 987_654_323)

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


# --- the transform ---------------------------------------------------------------------


def powers_of(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo the prime, by doubling."""
    out = np.ones(max(count, 1), np.uint64)
    done, step = 1, base % PRIME
    while done < count:
        more = min(done, count - done)
        out[done : done + more] = out[:more] * np.uint64(step) % _P
        step = step * step % PRIME
        done += more
    return out


@cache
def _twiddles(size: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    return powers_of(pow(root, -1, PRIME) if inverse else root, size // 2)


def transform(rows: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row; the result is in bit-reversed order."""
    count, size = rows.shape
    while size > 1:
        pairs = rows.reshape(count, -1, 2, size // 2)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.empty_like(pairs)
        rows[:, :, 0] = (low + high) % _P
        rows[:, :, 1] = (low + _P - high) * _twiddles(size, False) % _P
        size //= 2
    return rows.reshape(count, -1)


def inverse_transform(rows: np.ndarray) -> np.ndarray:
    """Undoes ``transform``, from bit-reversed order."""
    count, full = rows.shape
    size = 2
    while size <= full:
        pairs = rows.reshape(count, -1, 2, size // 2)
        low, high = pairs[:, :, 0], pairs[:, :, 1] * _twiddles(size, True) % _P
        rows = np.empty_like(pairs)
        rows[:, :, 0] = (low + high) % _P
        rows[:, :, 1] = (low + _P - high) % _P
        size *= 2
    return rows.reshape(count, -1) * np.uint64(pow(full, -1, PRIME)) % _P


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row: the sum of squared differences of its block to the window at every shift."""
    size, width = blocks.shape[1], windows.shape[1]
    full = 1 << (width - 1).bit_length()

    def padded(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), full), np.uint64)
        out[:, : rows.shape[1]] = rows
        return out

    product = inverse_transform(transform(padded(blocks[:, ::-1])) * transform(padded(windows)) % _P)
    # What wraps around lands before the first shift.
    mixed = product[:, size - 1 : width]
    sums = np.zeros((len(windows), width + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=sums[:, 1:])
    own = (blocks * blocks % _P).sum(axis=1, keepdims=True)
    return (own + sums[:, size:] - sums[:, : width - size + 1] + np.uint64(2) * (_P - mixed)) % _P


# --- places and their extension --------------------------------------------------------


class Prefixes:
    """Hashes of any stretch, to compare two stretches of any length at once."""

    def __init__(self, words: np.ndarray):
        self.count = len(words)
        self.tables = []
        for base in _BASES:
            powers = powers_of(base, self.count + 1)
            sums = np.zeros(self.count + 1, np.uint64)
            np.cumsum((words + np.uint64(1)) * powers[: self.count] % _P, out=sums[1:])
            self.tables.append((powers, sums % _P))

    def same(self, start: np.ndarray, distance: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the words from ``start`` on stand again ``distance`` further on. Equal words are
        always found the same."""
        out = np.ones(len(start), bool)
        for powers, sums in self.tables:
            here = (sums[start + length] + _P - sums[start]) % _P * powers[distance] % _P
            there = (sums[start + distance + length] + _P - sums[start + distance]) % _P
            out &= here == there
        return out

    def reach(self, start: np.ndarray, distance: np.ndarray, least: int, forward: bool) -> np.ndarray:
        """How many words from ``start`` on (or before it) stand again ``distance`` further on."""
        low = np.full(len(start), least, np.int64)
        high = self.count - start - distance if forward else start.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.same(start if forward else start - middle, distance, middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low


def _next_places(words: np.ndarray) -> np.ndarray:
    """How much further on each word comes again; beyond the end if it doesn't."""
    order = np.argsort(words, kind="stable")
    ahead = np.full(len(words), len(words) + 1, np.int64)
    again = words[order[1:]] == words[order[:-1]]
    ahead[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return ahead


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """Block length, least and greatest distance of each scale that a text of this length needs."""
    if longest >= SHORTEST:
        yield FIRST_BLOCK, 1, 2 * FIRST_BLOCK - 1
        size = 2 * FIRST_BLOCK
        while REPEATS * size <= longest:
            yield size, size, 2 * size - 1
            size *= 2


def occurrences(words: np.ndarray, ahead: np.ndarray, size: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) wherever a block of ``size`` words stands again ``least`` to ``most``
    words further on. A block with a word that doesn't come again so soon can't."""
    whole = len(words) // size
    starts = np.flatnonzero(ahead[: whole * size].reshape(-1, size).max(1) <= most) * size
    width = most - least + size
    at_once = max(1, CHUNK // (2 * width))
    nothing = words.max(initial=np.uint64(0)) + np.uint64(1)
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for first in range(0, len(starts), at_once):
        some = starts[first : first + at_once]
        places = some[:, None] + np.arange(least, least + width)
        windows = np.where(places < len(words), words[np.minimum(places, len(words) - 1)], nothing)
        rows, shifts = np.nonzero(squared_differences(words[some[:, None] + np.arange(size)], windows) == 0)
        found.append((some[rows], shifts + least))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _exact(words: np.ndarray, start: int, distance: int, size: int) -> tuple[int, int]:
    """The stretch around a place with this period, word by word."""
    if not np.array_equal(words[start : start + size], words[start + distance : start + distance + size]):
        return start, start
    end = start + distance + size
    while end < len(words) and words[end] == words[end - distance]:
        end += 1
    while start > 0 and words[start - 1] == words[start - 1 + distance]:
        start -= 1
    return start, end


def periodic_stretches(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, sorted. ``words``: numbers below the prime; ``longest``: no
    run is longer. Time grows with n log^2 n, whatever the text."""
    words = words.astype(np.uint64)
    if longest < SHORTEST:
        return []
    ahead, prefixes = _next_places(words), None
    least: dict[tuple[int, int], int] = {}
    for size, first, last in scales(longest):
        start, distance = occurrences(words, ahead, size, first, last)
        if not len(start):
            continue
        prefixes = prefixes or Prefixes(words)
        fits = start + distance + size <= len(words)
        start, distance = start[fits], distance[fits]
        # A sum may be a multiple of the prime without being zero.
        true = prefixes.same(start, distance, np.full(len(start), size))
        start, distance = start[true], distance[true]
        order = np.lexsort((start, distance))
        start, distance = start[order], distance[order]
        # Of neighbouring blocks that stand again at one distance the first leads to the same stretch.
        fresh = np.ones(len(start), bool)
        fresh[1:] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + size)
        start, distance = start[fresh], distance[fresh]
        begin = start - prefixes.reach(start, distance, 0, False)
        end = start + distance + prefixes.reach(start, distance, size, True)
        runs = end - begin >= np.maximum(SHORTEST, REPEATS * distance)
        for s, e, q, at in zip(begin[runs].tolist(), end[runs].tolist(), distance[runs].tolist(), start[runs].tolist()):
            if least.get((s, e), q + 1) <= q:
                continue
            same = np.array_equal(words[s : e - q], words[s + q : e])
            if not same:  # the hashes were wrong
                s, e = _exact(words, at, q, size)
                if e - s < max(SHORTEST, REPEATS * q):
                    continue
            least[s, e] = min(q, least.get((s, e), q))
    return sorted((s, e - s, q) for (s, e), q in least.items())


# --- texts -----------------------------------------------------------------------------


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given as lists of words."""
    numbers: dict[bytes, int] = {}
    parts, borders, at = [], [], 0
    for words in texts:
        parts += [numbers.setdefault(w, len(numbers)) for w in words]
        borders.append(at)
        at += len(words) + 1
        parts.append(-1)
    joined = np.array(parts, np.int64)
    # Between texts stands a number of its own, so that nothing repeats across it.
    between = np.flatnonzero(joined < 0)
    joined[between] = len(numbers) + np.arange(len(between))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    longest = max(map(len, texts), default=0)
    for start, length, period in periodic_stretches(joined, longest):
        text = int(np.searchsorted(borders, start, "right")) - 1
        out[text].append((start - borders[text], length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()])


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of consecutive texts, about ``SLICE_BYTES`` at a time, with the index of the first."""
    first, some, size = 0, [], 0
    for i, text in enumerate(texts.cast(pa.large_binary())):
        data = text.as_py() or b""
        some.append(_WORD.findall(data))
        size += len(data)
        if size >= SLICE_BYTES:
            yield first, some
            first, some, size = i + 1, [], 0
    if some:
        yield first, some


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed`` per row: the runs (``start, length, period`` in words, counted from
    0) by start and period, and the text with one period of each run, words joined by one space.

    Words are separated by blanks, tabs and line ends and compared as they are. Texts that are null,
    empty or shorter than 24 words have no runs. Rows that repeat an id or a text are rows of their
    own; an empty table gives no rows; other columns don't matter. Each task works on its rows alone, a
    few megabytes at a time or one longer text; time grows with n log^2 n for the longest, also where
    it is all one word. Nothing is shuffled.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, texts in _slices(batch.column("text")):
            runs = runs_of_texts(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[first : first + len(texts)],
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], _RUN_TYPE),
                    pa.array([collapsed(w, r) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "runs", "collapsed"],
            )

    return by_batch(texts_of(docs, id_column, text_column), work, RUNS)
