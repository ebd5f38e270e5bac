"""Plans run per micro-batch.

A file is read as a whole in the batch of its message, so its counts are complete without
any state. Each batch's load id is made of the stream's name, the query's own id (which lives
in its checkpoint) and the batch number: a batch that Spark repeats after a failure continues
its load instead of doubling it, and a new checkpoint begins new loads.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from waybill.operators.messages import located_messages, parse_messages
from waybill.operators.tables import LoadFolder
from waybill.plans.dynamic import JsonRouting
from waybill.plans.exact_name import ExactNameLoad
from waybill.plans.inferred import InferredLoad
from waybill.plans.load import FileLoad
from waybill.storage import SharedFiles

_KEPT_BATCHES = 2


def _trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every`` like ``5 seconds``; None takes what is there and stops."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when it made the checkpoint."""
    return json.loads(SharedFiles(spark).text(f"{checkpoint}/metadata"))["id"]


def run_per_batch(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    load: Callable[[DataFrame, str], object],
    every: str | None = None,
) -> StreamingQuery:
    """Starts a query that gives every non-empty micro-batch, with its load id, to ``load``.

    Started again with a new checkpoint, a stream loads all it finds again, also under the same name.
    """
    own: list[str] = []

    def on_batch(batch: DataFrame, number: int) -> None:
        if not own:
            own.append(query_id(batch.sparkSession, checkpoint))
        if not batch.isEmpty():
            load(batch, f"{name}-{own[0]}-{number}")
        # Spark never goes back further than the last batch.
        if number >= _KEPT_BATCHES:
            old = LoadFolder(batch.sparkSession, f"{name}-{own[0]}-{number - _KEPT_BATCHES}")
            old.files.remove(old.path)

    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(on_batch), every).start()


def start_file_loads(
    envelopes: DataFrame,
    load: FileLoad,
    name: str,
    checkpoint: str,
    every: str | None = None,
    strict_keys: bool = False,
) -> StreamingQuery:
    """Loads the files named by a stream of control messages."""
    return run_per_batch(
        envelopes, name, checkpoint,
        lambda batch, load_id: load.run(parse_messages(batch, strict_keys), load_id), every,
    )


def start_json_routing(
    envelopes: DataFrame, routing: JsonRouting, name: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Appends JSON messages to the tables they name."""
    return run_per_batch(envelopes, name, checkpoint, routing.run, every)


def start_roads(
    envelopes: DataFrame,
    routing: JsonRouting,
    roads: Mapping[str, str],
    name: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Appends the JSON messages of each topic to the topic's table."""
    return run_per_batch(
        envelopes, name, checkpoint,
        lambda batch, load_id: routing.run_roads(batch, roads, load_id), every,
    )


def start_inferred_loads(
    envelopes: DataFrame, load: InferredLoad, name: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Loads the files named by a stream, typed by their content."""
    return run_per_batch(envelopes, name, checkpoint, load.run, every)


def start_exact_name_loads(
    envelopes: DataFrame, load: ExactNameLoad, name: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Loads the files named by a stream, with the layouts of their exact names."""
    return run_per_batch(
        envelopes, name, checkpoint,
        lambda batch, load_id: load.run(located_messages(batch), load_id), every,
    )


def stored_batches(spark: SparkSession, name: str) -> list[str]:
    """Load folders a stream still keeps."""
    root = LoadFolder(spark, "_")
    return [s.name for s in root.files.glob(root.path.rsplit("/", 1)[0] + f"/{name}-*")]
