"""A reproducible shuffle into shards: a Feistel permutation over global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.frames import repeated, stored, texts_of
from waybill.llm.words import mix

ROUNDS = 6
ROWS_PER_BUCKET = 20_000


def feistel(values: np.ndarray, half_bits: int, seed: int, backwards: bool = False) -> np.ndarray:
    """A permutation of the numbers below ``4 ** half_bits``."""
    mask = np.uint64((1 << half_bits) - 1)
    left, right = values >> np.uint64(half_bits), values & mask
    keys = [mix(np.array([seed * ROUNDS + i + 1], np.uint64))[0] for i in range(ROUNDS)]
    if backwards:
        for key in reversed(keys):
            left, right = right ^ (mix(left + key) & mask), left
    else:
        for key in keys:
            left, right = right, left ^ (mix(right + key) & mask)
    return (left << np.uint64(half_bits)) | right


def walk(values: np.ndarray, count: int, seed: int, backwards: bool = False) -> np.ndarray:
    """A permutation of the numbers below ``count``: results beyond it are permuted again until they
    fall below (cycle walking; under four steps on average)."""
    half_bits = max(1, -(-(max(count, 2) - 1).bit_length() // 2))
    out = feistel(values.astype(np.uint64), half_bits, seed, backwards)
    while (beyond := out >= np.uint64(count)).any():
        out[beyond] = feistel(out[beyond], half_bits, seed, backwards)
    return out.astype(np.int64)


def place_of(row: int, count: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """(shard, slot) of a global row number."""
    place = int(walk(np.array([row]), count, seed)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, count: int, shards: int, seed: int = 0) -> int:
    """The global row number that has a place: any shard can be read in order without an index."""
    return int(walk(np.array([slot * shards + shard]), count, seed, backwards=True)[0])


def permuted(row: Column, count: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(walk(rows.to_numpy(), count, seed))

    return place(row)


def row_numbers(
    keys: DataFrame, first: tuple[str, ...] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> tuple[DataFrame, int]:
    """Numbers from 0 for all rows (``row``), by content alone, and the count of rows.

    ``keys`` has one row per distinct content with its count of ``repeats``, which takes so many
    numbers from ``row`` on. ``first`` names columns of few values (at most some thousands, none of them
    null). Rows are dealt to buckets by hash, numbered inside each bucket, and the
    buckets' sums (one row each) shift them; numbers rise with the columns ``first``. No sampling
    decides anything, so another cluster or partitioning gives the same numbers.
    """
    columns = [c for c in keys.columns if c != "repeats"]
    count = keys.agg(F.sum("repeats")).first()[0] or 0
    # As many buckets for each value of ``first`` as its rows fill, so that bucket sums stay few.
    size = keys.groupBy(*[F.col(c).alias(f"_{c}") for c in first]).agg(F.count("*").alias("distinct"))
    same = F.lit(True)
    for c in first:
        same = same & (F.col(c) == F.col(f"_{c}"))
    bucket = F.pmod(F.xxhash64(*columns), F.expr(f"distinct div {rows_per_bucket} + 1"))
    keys = keys.join(F.broadcast(size), same).select(*keys.columns, bucket.alias("bucket"))
    group = [*first, "bucket"]
    sums = keys.groupBy(*group).agg(F.sum("repeats").alias("rows"))
    before = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(*group, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))
    order = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    inside = F.sum("repeats").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = keys.withColumn("inside", inside - F.col("repeats")).join(shifts, group)
    return numbered.select(*columns, "repeats", (F.col("inside") + F.col("shift")).alias("row")), count


def shard_rows(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every row's ``shard`` and ``slot``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``rows``: place = permutation(row number), shard = place mod shards, slot = place div
    shards, so that shards differ by at most one row and slots have no gaps. ``size``: UTF-8 bytes of
    the text and 1; a null text has none and the crc32 of an empty one. Rows that repeat id and text
    get a place each. Rows without an id are placed like all others. An empty table gives no rows.
    """
    texts = texts_of(docs, id_column, text_column)
    keys = texts.select(
        "doc_id", (F.octet_length("text").cast("long") + 1).alias("size"), F.crc32("text").alias("text_crc32")
    )
    keys = stored(keys.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("repeats")), "shard-keys")
    numbered, count = row_numbers(keys)
    rows = repeated(numbered).withColumn("row", F.col("row") + F.col("nth"))
    place = permuted(F.col("row"), count, seed)
    return (
        rows.withColumn("place", place)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            (F.col("place") % shards).cast("int").alias("shard"),
            F.expr(f"place div {shards}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
