"""Connected components of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import stored


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node, component`` (smallest node reached) of all nodes in ``links`` (``a, b``).

    Each round a node takes the smallest label among its own and its neighbours', then its label's
    label, so that distances halve. With ``rounds`` it stops early: equal labels then still mean
    connected, different ones need not mean apart.
    """
    both = stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    done = 0
    while rounds is None or done < rounds:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("nearest"))
        )
        lower = labels.join(near, "node").select("node", F.least("component", "nearest").alias("component"), F.col("component").alias("before"))
        targets = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = lower.join(targets, "component", "left").select(
            "node", F.least("component", F.coalesce("further", "component")).alias("component"), "before"
        )
        moved = stored(moved, "labels")
        labels = moved.select("node", "component")
        done += 1
        if moved.where("component <> before").isEmpty():
            break
    return labels
