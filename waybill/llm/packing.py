"""Best-two-fit packing of token sequences, planned over counts of lengths."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import by_batch, repeated, stored, texts_of
from waybill.llm.shard import row_numbers

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k"
MEMO_ENTRIES = 1 << 19


class Encoder:
    """Ids of a byte-level vocabulary as bytes (unsigned 32-bit, little-endian).

    The ids are those of ``tokenizers`` with ``add_special_tokens=False``. A text without two white
    spaces in a row is cut before each space: no token spans such a place, so that a word's ids can
    be remembered. Other texts are encoded as a whole; texts that spell a special token go through
    ``tokenizers`` itself.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str):
        import base64
        import re

        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        specials = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, specials)) or r"(?!)")
        self._blank_run = re.compile(r"\s\s|\s\Z")
        self._memo: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self._encoding.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self._special.search(text):
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        if self._blank_run.search(text):
            return self._plain(text)
        first, *rest = text.split(" ")
        memo = self._memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        out = [self._plain(first)]
        for word in rest:
            ids = memo.get(word)
            if ids is None:
                ids = memo[word] = self._plain(" " + word)
            out.append(ids)
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The vocabulary's encoder, made once in each Python worker."""
    if vocabulary not in _encoders:
        import public_tokenizers

        _encoders[vocabulary] = Encoder(
            public_tokenizers.path(f"{vocabulary}.json"),
            public_tokenizers.path(f"{vocabulary}.tiktoken"),
            public_tokenizers.PATTERN,
        )
    return _encoders[vocabulary]


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first."""
    first = length - (length - 1) // capacity * capacity
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def token_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian 32-bit) of all rows."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32"))]
    if with_ids:
        schema, fields = schema + ", ids binary", [*fields, ("ids", pa.binary())]
    arrow = pa.schema(fields)
    end = np.array([END_ID], "<u4").tobytes()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        rows: list[list] = [[] for _ in fields]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = encode(text.as_py()) + end
            for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                part = ids[4 * start : 4 * (start + length)]
                for column, value in zip(rows, (doc_id, piece, start, length, zlib.crc32(part), part)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow)], schema=arrow)

    return by_batch(texts_of(docs, id_column, text_column), work, schema)


@dataclass(frozen=True)
class Run:
    """Rows ``first_row`` to ``first_row + rows - 1`` (all of one length): ``each`` of them go to every
    one of the consecutive sequences from ``sequence`` on, side by side from ``offset`` on."""

    first_row: int
    rows: int
    each: int
    sequence: int
    offset: int
    length: int


@dataclass
class Plan:
    sequences: int = 0
    runs: list[Run] = field(default_factory=list)


class Lengths:
    """Counts of unpacked documents by length."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self._index = np.arange(len(counts))

    def at_most(self, counts: np.ndarray) -> np.ndarray:
        """For every room the longest unpacked length that fits, 0 if none does."""
        return np.maximum.accumulate(np.where(counts > 0, self._index, 0))

    def fill(self, capacity: int) -> Counter:
        """Best fit: again and again the longest document that fits the gap."""
        counts, chosen, gap = self.counts.copy(), Counter(), capacity
        fitting = self.at_most(counts)
        while gap and (length := int(fitting[gap])):
            take = min(int(counts[length]), gap // length)
            chosen[length] += take
            counts[length] -= take
            gap -= take * length
            if not counts[length]:
                fitting = self.at_most(counts)
        return chosen

    def two_fit(self, chosen: Counter, capacity: int) -> Counter:
        """While there is a gap: the smallest document goes if two unpacked ones fill more of its
        place and the gap; of all such pairs the tightest."""
        gap = capacity - sum(length * n for length, n in chosen.items())
        while gap and chosen:
            smallest = min(chosen)
            counts = self.counts.copy()
            for length, n in chosen.items():
                counts[length] -= n
            room = gap + smallest
            longer = np.flatnonzero(counts[:room] > 0)
            if not len(longer):
                break
            second = self.at_most(counts)[np.minimum(room - longer, longer)]
            # The same length twice needs two of them; else the next shorter one.
            shorter = np.concatenate([[0], self.at_most(counts)])[longer]
            second = np.where((second == longer) & (counts[longer] < 2), shorter, second)
            sums = np.where(second > 0, longer + second, 0)
            best = int(sums.argmax())
            if sums[best] <= smallest:
                break
            chosen[smallest] -= 1
            chosen += Counter()
            chosen.update([int(longer[best]), int(second[best])])
            gap = room - int(sums[best])
        return chosen


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-two-fit over counts of lengths; rows are numbered from 0 in order of length.

    A filled sequence is repeated as long as documents of its lengths last, so that the work depends
    on the capacity and not on the number of documents.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    next_row = np.concatenate([[0], np.cumsum(left)[:-1]])
    plan, lengths = Plan(), Lengths(left)
    while left.any():
        chosen = lengths.two_fit(lengths.fill(capacity), capacity)
        times = min(int(left[length]) // n for length, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            plan.runs.append(Run(int(next_row[length]), n * times, n, plan.sequences, offset, length))
            next_row[length] += n * times
            left[length] -= n * times
            offset += n * length
        plan.sequences += times
    return plan


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A document is its ids and id 0, a null or empty text id 0 alone. Documents longer than
    ``capacity`` are cut (see ``cuts``). The driver sees one count per length, at most ``capacity``
    numbers; all pieces are numbered in order of length by hash buckets, and the plan says for runs
    of row numbers where they go. Rows that repeat are packed as often as they occur; rows without an
    id like all others. An empty table gives no rows.
    """
    pieces = token_pieces(docs, capacity, vocabulary, id_column, text_column)
    columns = ["length", "doc_id", "piece", "start", "ids_crc32"]
    pieces = stored(pieces.groupBy(*columns).agg(F.count("*").alias("repeats")), "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.sum("repeats")).collect()}
    runs = sorted(packing_plan(counts, capacity).runs, key=lambda r: r.first_row)
    starts, each, sequence, offset, length = (
        np.array([getattr(r, name) for r in runs], np.int64)
        for name in ("first_row", "each", "sequence", "offset", "length")
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(rows: pd.Series) -> pd.DataFrame:
        rows = rows.to_numpy()
        run = np.searchsorted(starts, rows, "right") - 1
        inside = rows - starts[run]
        return pd.DataFrame(
            {
                "sequence_id": sequence[run] + inside // each[run],
                "offset": offset[run] + inside % each[run] * length[run],
            }
        )

    numbered, _ = row_numbers(pieces, first=("length",))
    return (
        repeated(numbered)
        .withColumn("place", place(F.col("row") + F.col("nth")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
    )
