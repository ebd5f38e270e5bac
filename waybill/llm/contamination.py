"""Benchmark items inside documents: MinHash containment search, partitioned by the items' size.

An item is contained in a document if at least 80 of 100 of its distinct word shingles occur there.
Such a document lacks at most ``n - ceil(0.8 n)`` of an item's ``n`` shingles, so that of the item's
smallest ``n - ceil(0.8 n) + 1`` hash values (its MinHash sketch) it has at least one. Sketches that
long lose nothing; items of similar size share a partition, whose largest sketch value says which of
a document's shingles are looked up, and whose smallest item which documents are long enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import by_batch, ship
from waybill.llm.jaccard import needed
from waybill.llm.words import SHINGLE, Words, words_of

BLOCK_BYTES = 16 << 20


@dataclass
class Partition:
    """Items of similar size: their sketches as sorted ``values`` with their ``owners``."""

    smallest: int
    values: np.ndarray
    owners: np.ndarray


@dataclass
class Sketches:
    """Distinct items by number: ``shingles`` (sorted), and the partitions."""

    item_ids: list[list[int | None]]
    shingles: list[np.ndarray]
    partitions: list[Partition]


def sketches(item_ids: list, texts: pa.Array) -> Sketches:
    """Items with equal shingles are one; items without words are left out."""
    distinct: dict[bytes, int] = {}
    ids: list[list] = []
    sets: list[np.ndarray] = []
    for begin, words in words_of(texts):
        values, first = words.shingles(SHINGLE)
        for i in range(len(words)):
            shingles = np.unique(values[first[i] : first[i + 1]])
            if len(shingles):
                number = distinct.setdefault(shingles.tobytes(), len(sets))
                if number == len(sets):
                    sets.append(shingles)
                    ids.append([])
                ids[number].append(item_ids[begin + i])
    by_class: dict[int, list[int]] = {}
    for number, shingles in enumerate(sets):
        by_class.setdefault(len(shingles).bit_length(), []).append(number)
    partitions = []
    for members in by_class.values():
        parts = [sets[m][: len(sets[m]) - needed(len(sets[m])) + 1] for m in members]
        values, owners = np.concatenate(parts), np.repeat(members, [len(p) for p in parts])
        order = np.argsort(values, kind="stable")
        partitions.append(Partition(min(needed(len(sets[m])) for m in members), values[order], owners[order]))
    return Sketches(ids, sets, partitions)


def found(words: Words, known: Sketches) -> Iterator[tuple[int, int, int]]:
    """(text, item number, shared shingles) of all contained items."""
    values, first = words.shingles(SHINGLE)
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(words)), sizes)
    candidates: set[tuple[int, int]] = set()
    for part in known.partitions:
        chosen = (values <= part.values[-1]) & (sizes >= part.smallest)[owner]
        looked_up, texts = values[chosen], owner[chosen]
        low = np.searchsorted(part.values, looked_up, "left")
        high = np.searchsorted(part.values, looked_up, "right")
        for hit in np.flatnonzero(high > low):
            candidates.update((int(texts[hit]), int(o)) for o in part.owners[low[hit] : high[hit]])
    last, own = -1, np.zeros(0, np.uint64)
    for text, number in sorted(candidates):
        if text != last:
            last, own = text, np.unique(values[first[text] : first[text + 1]])
        item = known.shingles[number]
        at = np.minimum(np.searchsorted(own, item), len(own) - 1)
        shared = int((own[at] == item).sum())
        if shared >= needed(len(item)):
            yield text, number, shared


def blocks_of(items: DataFrame, id_column: str, text_column: str, block_bytes: int = BLOCK_BYTES) -> Iterator[Sketches]:
    """The items' sketches in blocks of at most about ``block_bytes`` of text: a benchmark of any size
    is searched for, block by block, and no more than one block is sent out at once."""
    rows = items.select(
        items[id_column].cast("long").alias("item_id"), F.coalesce(items[text_column].cast("string"), F.lit("")).alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    count = 2 * (total // block_bytes) + 1
    for block in range(count):
        mine = rows if count == 1 else rows.where(F.pmod(F.xxhash64("text"), F.lit(count)) == block)
        batch = mine.toArrow()
        if batch.num_rows:
            yield sketches(batch.column("item_id").to_pylist(), batch.column("text").combine_chunks())


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``doc_id, item_id, item_shingles, shared, containment`` of every item contained in a row.

    Documents without any are not returned. Null and empty texts and items contain nothing and are
    contained in nothing; an item of fewer than five words is one shingle, which only an equal text
    has. Rows and items that repeat, or have no id, are returned each. Empty tables give no rows.
    """
    ship(docs.sparkSession)
    spark, schema = docs.sparkSession, "doc_id long, item_id long, item_shingles long, shared long, containment double"
    result = None
    for known in blocks_of(items, item_id_column, item_text_column):
        shared_block = spark.sparkContext.broadcast(known)

        def work(batch: pa.RecordBatch, block=shared_block) -> Iterator[pa.RecordBatch]:
            ids, out = batch.column(0).to_pylist(), []
            for begin, words in words_of(batch.column(1)):
                for text, number, shared in found(words, block.value):
                    n = len(block.value.shingles[number])
                    out += [(ids[begin + text], item, n, shared, shared / n) for item in block.value.item_ids[number]]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["doc_id", "item_id", "item_shingles", "shared", "containment"],
                )

        texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
        part = by_batch(texts, work, schema)
        result = part if result is None else result.unionByName(part)
    return spark.createDataFrame([], schema) if result is None else result


def without_items(docs: DataFrame, items: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that contain no item."""
    ship(docs.sparkSession)
    for known in blocks_of(items, "item_id", "text"):
        shared_block = docs.sparkSession.sparkContext.broadcast(known)

        def work(batch: pa.RecordBatch, block=shared_block) -> Iterator[pa.RecordBatch]:
            clean = np.ones(batch.num_rows, bool)
            texts = batch.column(batch.schema.get_field_index(text_column)).cast(pa.string())
            for begin, words in words_of(texts):
                for text, _, _ in found(words, block.value):
                    clean[begin + text] = False
            yield batch.filter(pa.array(clean))

        docs = by_batch(docs, work, docs.schema)
    return docs
