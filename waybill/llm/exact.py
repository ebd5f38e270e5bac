"""Exact dedup in three steps that no hot text can stall: local, salted, global."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.frames import repeated, stored, texts_of

SALTS = 32


def salt_winners(rows: DataFrame) -> DataFrame:
    """One row per digest, salt and whole text: the largest id and the count.

    Grouping by the text itself compares full content. Each task first combines the rows it has read
    (the partial aggregate), so that of a text held by a third of all rows only one row per task and
    salt is shuffled.
    """
    return rows.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def global_winners(salted: DataFrame) -> DataFrame:
    """The salted rows with the winner over all salts, full content compared again.

    A digest has at most one row per salt and content here. ``clash`` says that the digest has
    more than one content.
    """
    content = Window.partitionBy("digest", "text")
    digest = Window.partitionBy("digest")
    return salted.select(
        "digest",
        "salt",
        "text",
        F.max("doc_id").over(content).alias("keep_id"),
        F.sum("copies").over(content).alias("group_size"),
        (F.min("text").over(digest) != F.max("text").over(digest)).alias("clash"),
    )


def _by_text(rows: DataFrame) -> DataFrame:
    """Members of the groups of equal texts where the digest alone doesn't tell them apart."""
    winners = global_winners(salt_winners(rows)).drop("clash")
    members = rows.groupBy("digest", "salt", "text", "doc_id").agg(F.count("*").alias("repeats"))
    return members.join(winners, ["digest", "salt", "text"]).drop("text")


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = SALTS
) -> DataFrame:
    """The group of equal texts of every row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are compared as they are, a null text as an empty one. The row with the largest id stays.
    Of rows that repeat both id and text exactly one is kept; rows without an id lose against any
    that has one, and of a group without any id one row stays (``keep_id`` is null). An empty table
    gives no rows; other columns of ``docs`` don't matter, whatever their names.
    """
    rows = texts_of(docs, id_column, text_column).select(
        "doc_id",
        "text",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    )
    # Where a digest has one content, as the winners have shown, it stands for the text from here on.
    winners = stored(global_winners(salt_winners(rows)).drop("text"), "salt-winners")
    members = rows.groupBy("digest", "salt", "doc_id").agg(F.count("*").alias("repeats"))
    found = members.join(winners.where(~F.col("clash")).drop("clash"), ["digest", "salt"])
    clashing = winners.where("clash").select("digest").distinct()
    if not clashing.isEmpty():
        found = found.unionByName(_by_text(rows.join(clashing, "digest", "left_semi")))
    return (
        repeated(found)
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 0)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Of rows that repeat both id and text one stays."""
    groups = exact_groups(docs, id_column, text_column).groupBy(
        F.col("doc_id").alias("_own_id"), F.col("text_sha256").alias("_own_text")
    )
    rows = stored(groups.agg(F.max("kept").alias("stays"), F.count("*").alias("rows")), "stays")
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    same = docs[id_column].cast("long").eqNullSafe(F.col("_own_id")) & (F.sha2(text, 256) == F.col("_own_text"))
    repeated_rows = rows.where("stays AND rows > 1")
    kept = docs.join(rows.where("NOT stays OR rows > 1"), same, "left_anti")
    if not repeated_rows.isEmpty():
        one = Window.partitionBy("_own_id", "_own_text").orderBy(F.lit(1))
        again = docs.join(repeated_rows, same).withColumn("_nth", F.row_number().over(one)).where("_nth = 1")
        kept = kept.unionByName(again.select(*[again[c] for c in docs.columns]))
    return kept
