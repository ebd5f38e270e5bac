"""Equi-joins of big frames with frames that are usually, but not surely, small."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
LINE_SALTS = 64
"""Salts for lines: a file may hold a third of all of them."""


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    @property
    def fits(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


def measure(df: DataFrame) -> Size:
    """Rows and text bytes of a frame, by one aggregate over it."""
    text = F.octet_length(F.to_json(F.struct("*")))
    row = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(text), F.lit(0)).alias("bytes")).first()
    return Size(row["rows"], row["bytes"])


def attach(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    size: Size | None = None,
    salts: int = 1,
) -> DataFrame:
    """``big`` joined with ``small`` on ``keys``; ``how`` is inner, left, left_semi or left_anti.

    ``small`` is broadcast if its measured size is within the bound. Beyond it both sides
    are shuffled, where adaptive execution splits skewed partitions. ``salts`` splits hot
    keys up front: ``big`` is salted by its own partitions (the same on every retry) and
    ``small`` repeated once per salt; meant for a ``small`` that stays far behind ``big``.
    """
    keys = list(keys)
    if (size or measure(small)).fits:
        return big.join(F.broadcast(small), keys, how)
    if salts == 1:
        return big.join(small, keys, how)
    salted = big.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def beside_list(df: DataFrame, side: DataFrame, name: str = "side", salts: int = LINE_SALTS) -> DataFrame:
    """Every row with the list of another frame's rows beside it, sorted by their columns in order.

    The list is one value of each row by its nature; it is made and handed out by Spark, once per
    salt, and meets the rows in a join on the salt.
    """
    values = side.agg(F.sort_array(F.collect_list(F.struct(*side.columns))).alias(name))
    dealt = values.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    return salted.join(dealt, "_salt").drop("_salt")
