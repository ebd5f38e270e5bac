"""Faults planted by a fixed rule, so that the operators that mend them have something to find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with nulls in role and text as one space, and damaged by the
    crc32 of ``conv_id:turn`` (a null as one space) modulo 20: 0 drops the row, 1 empties its text,
    2 removes its ``.!?``, 3 repeats it, 4 makes it a user's."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    own = rows.select(
        rows["conv_id"].cast("long").alias("conv_id"),
        rows["turn"].cast("long").alias("turn"),
        F.coalesce(rows["role"].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows["text"].cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("fault", F.crc32(key.cast("binary")) % 20)
    fault, text = F.col("fault"), F.col("text")
    return own.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of every tenth document (by the crc32 h of its id) the words from a on are
    replaced by repeats of the p words at a, where g = h div 10, a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8). A null text is empty; a row without an id stays as it is."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    ).withColumn("number", number)
    chosen = F.coalesce(F.col("number") % 10 == 0, F.lit(False)) & F.col("text").rlike(WORD)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(F.col("number") / 10)
    planted = (
        own.where(chosen)
        .select("doc_id", words.alias("words"), g.alias("g"))
        .withColumn("n", F.size("words").cast("long"))
        .withColumn("a", F.col("g") % F.col("n"))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    )

    def word_at(i: Column) -> Column:
        start = F.col("a")
        place = F.when(i < start, i).otherwise(start + (i - start) % F.col("p"))
        return F.get(F.col("words"), place.cast("int"))

    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), word_at), " ")
    return own.where(~chosen).select("doc_id", "text").unionByName(planted.select("doc_id", text.alias("text")))
