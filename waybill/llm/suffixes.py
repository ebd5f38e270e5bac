"""Passages that repeat word for word across documents: a sparse suffix array.

Suffixes are kept where they begin with a minimiser: the smallest hash of a run of five words among
``WINDOW`` neighbouring ones. Content alone decides, so that two copies of a passage keep the same
suffixes. Around suffixes whose first ``SHARED`` words stand in two documents or more, every run of
``MIN_WORDS`` words is looked up in all documents: whole groups are aggregated, none is compared in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.frames import by_batch, ship, stored, texts_of
from waybill.llm.words import SHINGLE, Words, rolling, run_hashes, words_of

MIN_WORDS = 50
WINDOW = 11
SHARED = MIN_WORDS - WINDOW + 1
BROADCAST_BYTES = 32 << 20


def minimisers(words: Words, size: int = SHINGLE, window: int = WINDOW) -> np.ndarray:
    """Places (word numbers) whose run of ``size`` words has the smallest hash of some ``window``
    consecutive runs of the same text."""
    values = rolling(words.hashes, size)
    windows = len(values) - window + 1
    if windows <= 0:
        return np.zeros(0, np.int64)
    lowest = values[:windows].copy()
    for i in range(1, window):
        np.minimum(lowest, values[i : i + windows], out=lowest)
    ends = np.repeat(words.first[1:], np.diff(words.first))
    inside = np.arange(windows) + window + size - 1 <= ends[:windows]
    lowest[~inside] = 0
    highest = np.zeros(len(values), np.uint64)
    for i in range(window):
        np.maximum(highest[i : i + windows], lowest, out=highest[i : i + windows])
    return np.flatnonzero((highest == values) & (values > 0))


def suffixes(texts: DataFrame, shared: int = SHARED) -> DataFrame:
    """``key`` (hash of the first ``shared`` words), ``doc_id, pos`` of all suffixes."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for begin, words in words_of(batch.column("text")):
            at = minimisers(words)
            text = np.searchsorted(words.first, at, "right") - 1
            fits = at + shared <= words.first[text + 1]
            at, text = at[fits], text[fits]
            if not len(at):
                continue
            key = run_hashes(words.hashes, at, shared)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(ids[begin + text].astype(np.int64)),
                    pa.array((at - words.first[text]).astype(np.int32)),
                ],
                names=["key", "doc_id", "pos"],
            )

    return by_batch(texts, work, "key long, doc_id long, pos int")


def in_two_documents(rows: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` two documents or more have, with the smallest of these, ``least_doc``."""
    owners = rows.groupBy("key").agg(F.min("doc_id").alias("least_doc"), F.max("doc_id").alias("greatest_doc"))
    return rows.join(owners.where("least_doc < greatest_doc").drop("greatest_doc"), "key")


def runs_around(texts: DataFrame, places: DataFrame, size: int, before: int) -> DataFrame:
    """``key`` (hash), ``doc_id, start`` of all runs of ``size`` words that begin at one of the
    ``places`` (``doc_id, pos``) or up to ``before`` words earlier."""
    by_doc = stored(places.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("places")), "places")
    if (by_doc.agg(F.sum(F.size("places") + 4)).first()[0] or 0) * 4 <= BROADCAST_BYTES:
        by_doc = F.broadcast(by_doc)
    earlier = np.arange(before + 1)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        places_of = batch.column("places")
        for begin, words in words_of(batch.column("text")):
            at, text = [], []
            for i in range(len(words)):
                pos = places_of[begin + i].values.to_numpy(zero_copy_only=False)
                starts = np.unique(pos[:, None] - earlier)
                starts = starts[(starts >= 0) & (starts + size <= words.first[i + 1] - words.first[i])]
                at.append(starts + words.first[i])
                text.append(np.full(len(starts), i))
            at, text = np.concatenate(at).astype(np.int64), np.concatenate(text).astype(np.int64)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(run_hashes(words.hashes, at, size).view(np.int64)),
                        pa.array(ids[begin + text]),
                        pa.array((at - words.first[text]).astype(np.int32)),
                    ],
                    names=["key", "doc_id", "start"],
                )

    joined = texts.join(by_doc, "doc_id").select("doc_id", "text", "places")
    return stored(by_batch(joined, work, "key long, doc_id long, start int"), "runs")


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, start, end, words, first``: the spans of words (``end`` excluded) that also stand in
    another document, at least ``min_words`` long; overlapping ones are joined. ``first``: no run of
    ``min_words`` words in it stands in a document of a smaller id, so that the passage may stay there.

    Every run of ``min_words`` words has a suffix among its first ``WINDOW`` places, the same in all its
    copies, with ``min_words - WINDOW + 1`` or more of its words to the right. So all runs that stand in
    two documents lie around suffixes that do, and each is looked up by the hash of all its words.
    Repeats inside one document alone, also by rows that repeat its id, are not reported; rows without
    an id can't be named and are left out; null, empty and short texts have none. An empty table gives
    no rows.
    """
    ship(docs.sparkSession)
    shared = min_words - WINDOW + 1
    texts = texts_of(docs, id_column, text_column).where("doc_id IS NOT NULL")
    places = in_two_documents(stored(suffixes(texts, shared), "suffixes")).select("doc_id", "pos")
    runs = in_two_documents(runs_around(texts, places, min_words, WINDOW - 1))
    return joined_spans(
        runs.groupBy("doc_id", "start")
        .agg(F.max(F.col("doc_id") > F.col("least_doc")).alias("later"))
        .select("doc_id", "start", (F.col("start") + min_words).alias("end"), "later")
    )


def joined_spans(spans: DataFrame) -> DataFrame:
    """Overlapping or touching spans of a document as one; ``first`` if none of them is ``later``."""
    along = Window.partitionBy("doc_id").orderBy("start", "end")
    reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") > reached, F.lit(True))
    numbered = spans.withColumn("begins", begins.cast("int")).withColumn("span", F.sum("begins").over(along))
    merged = numbered.groupBy("doc_id", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("later").alias("later"))
    return merged.select(
        "doc_id", F.col("start").cast("long"), F.col("end").cast("long"), (F.col("end") - F.col("start")).cast("long").alias("words"), (~F.col("later")).alias("first")
    )
