"""Small files to the stream, big files to the batch load."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.layouts import BATCH_SIZE_THRESHOLD
from waybill.operators.messages import with_problem
from waybill.operators.routing import STREAM, route_by_size
from waybill.operators.tables import LoadFolder
from waybill.plans.load import FileLoad, kept_slice_size, url_slices
from waybill.sources.listing import file_sizes


def dispatch(
    messages: DataFrame,
    publish: Callable[[DataFrame], None],
    load: FileLoad,
    threshold: int = BATCH_SIZE_THRESHOLD,
    load_id: str | None = None,
) -> str:
    """Routes messages (of ``parse_messages``, ``event_messages`` or ``messages_frame``) by the size of their files.

    Messages of small files are given to ``publish`` unchanged, as ``value, message_id,
    message_ts``; those of big files, and those without a file or with a problem, to the
    load, predicate included.
    """
    load_id = load_id or uuid.uuid4().hex
    folder = LoadFolder(load.spark, f"dispatch-{load_id}")
    if folder.complete:
        return load_id
    stored = folder.store(with_problem(messages), "messages")
    size = kept_slice_size(folder, load.urls_per_slice)
    for number, part, urls in url_slices(stored.filter(F.col("problem") == ""), size):
        sizes = file_sizes(load.spark, urls)
        routed = folder.store(route_by_size(part, sizes, threshold), f"routed/slice={number}")
        to_stream = F.coalesce(F.col("route") == STREAM, F.lit(False))
        small = routed.filter(to_stream).select(F.col("message").alias("value"), "message_id", "message_ts")
        folder.once(f"publish-{number}", lambda small=small: publish(small))
        load.run(routed.filter(~to_stream).drop("route", "length"), f"{load_id}-{number}")
    load.run(stored.filter(F.col("problem") != ""), f"{load_id}-problems")
    folder.finish(("messages", "settings", "routed"))
    return load_id
