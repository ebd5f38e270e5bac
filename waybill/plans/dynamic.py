"""JSON rows to the table named inside the message, or to the table of their topic."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.layouts import DEAD_LETTER_SCHEMA, JSON_LOG_SCHEMA
from waybill.operators.routing import ORIGIN, rows_by_topic, rows_with_target
from waybill.operators.tables import LoadFolder, Targets


@dataclass
class JsonRouting:
    """Settings; ``run`` and ``run_roads`` write one set of envelopes.

    Any number of tables can be named. The rows are stored once, split by table, and each
    table's append reads its own part only; hot tables are split into even files.
    """

    spark: SparkSession
    targets: Targets = field(default_factory=lambda: Targets(create=True))
    schema: T.StructType = field(default_factory=lambda: JSON_LOG_SCHEMA)
    table_field: str = "target_table"
    keep_table_field: bool = False
    parallel_writes: int = 4

    def run(self, envelopes: DataFrame, load_id: str | None = None) -> str:
        """Every row goes to the table its ``target_table`` names."""
        rows = rows_with_target(
            envelopes, self.schema, self.table_field, self.keep_table_field, with_origin=True
        )
        return self._write(rows, load_id)

    def run_roads(self, envelopes: DataFrame, roads: Mapping[str, str], load_id: str | None = None) -> str:
        """Every row goes to the table of its topic."""
        return self._write(rows_by_topic(envelopes, roads, self.schema, with_origin=True), load_id)

    def _write(self, rows: DataFrame, load_id: str | None) -> str:
        load_id = load_id or uuid.uuid4().hex
        folder = LoadFolder(self.spark, load_id)
        if folder.complete:
            return load_id
        lost = F.col("problem") != ""
        rows = rows.withColumn("target", F.when(~lost, F.col("target"))).withColumn("lost", lost)
        stored = folder.store(rows.hint("rebalance", "target"), "rows", ("lost", "target"))
        columns = [f for f in rows.schema.fields if f.name not in ("target", "problem", "message", "lost", *ORIGIN)]
        good = stored.filter(~F.col("lost"))
        table_schema = T.StructType(columns)

        def append_one(name: str) -> None:
            part = good.filter(F.col("target") == name).select(*table_schema.names)
            self.targets.append(part, self.targets.result(name), table_schema, load_id, "rows")

        names = (row[0] for row in good.select("target").distinct().toLocalIterator())
        with ThreadPoolExecutor(self.parallel_writes) as pool:
            while some := list(islice(names, 256)):
                list(pool.map(lambda n: folder.once(f"rows-{n}", lambda: append_one(n)), some))
        folder.once("dead_letters", lambda: self._dead_letters(stored.filter(F.col("lost")), load_id))
        folder.finish(("rows",))
        return load_id

    def _dead_letters(self, lost: DataFrame, load_id: str) -> None:
        number, time = ORIGIN
        letters = lost.select(
            F.col(time).alias("timestamp"), F.col("problem").alias("reason"), F.col(number).alias("message_id"), "message"
        )
        if not letters.isEmpty():
            self.targets.append(letters, self.targets.dead_letters, DEAD_LETTER_SCHEMA, load_id, "dead_letters")
