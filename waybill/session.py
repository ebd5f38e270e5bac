"""Session settings the loads profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Zone-less event times are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streams keep their state outside the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Adds the settings to a session builder; the caller's own settings come after."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder

