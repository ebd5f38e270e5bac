"""Documents through toxicity, exact dedup, similarity, decontamination and packing.

Each stage takes all rows that the one before has kept and returns them with the columns of
``documents``, but for the last, which returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.llm.contamination import without_items
from waybill.llm.exact import without_copies
from waybill.llm.frames import stored, table
from waybill.llm.jaccard import one_of_each_group
from waybill.llm.packing import pack
from waybill.llm.toxicity import learnt_lexicon, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted to be toxic go. The lexicon is learnt from the labelled rows of ``docs``."""
    return without_toxic(docs, learnt_lexicon(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return without_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similarity the one with the smallest id stays."""
    return one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain an item of ``benchmark`` go."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# SQL can express neither the learnt lexicon nor the tokens; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
