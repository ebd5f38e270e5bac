"""Seconds per headline query, as one JSON line.

Every query is run once to warm up and then ``BENCH_RUNS`` times (default 3); the median
counts. A query's rows are all computed (into the no-op sink); loads include writing the
feed files and the tables.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from queryset.queries import QUERIES
from waybill.session import configure

HEADLINE = (
    "load_monitoring",
    "lineitem_load_monitoring",
    "lineitem_reject_reasons",
    "load_start_events",
    "load_valid_client",
    "load_rejects",
    "bad_file_threshold",
    "message_broadcast_join",
    "message_validation",
    "json_payload_parse",
    "dynamic_route_counts",
    "three_roads",
    "tumbling_1s",
    "size_router",
    "header_skip",
    "batch_load_monitoring",
    "lineitem_file_load",
    "stream_load_monitoring",
    "dynamic_route_tables",
    "inferred_schema_load",
)


def session(cpus: str) -> SparkSession:
    builder = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
