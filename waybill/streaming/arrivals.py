"""Messages that wait for their file: two streams joined by path.

Storage tells of new files on a topic of its own, and a message may come before its file or after it.
The two streams meet in an outer join on the path, within a bounded time of each other; the watermarks
of both sides free the state, and a message that is still alone by then comes out without a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill import layouts
from waybill.functions.payload import json_value, parsed_once, payload_text, string_field
from waybill.operators.messages import located_messages
from waybill.plans.exact_name import ExactNameLoad
from waybill.sources.listing import qualified
from waybill.streaming.loader import run_per_batch

WAIT = "10 minutes"


def file_arrivals(envelopes: DataFrame) -> DataFrame:
    """``file_path, arrived`` from a topic of storage events (``{"file": path}``); others are no arrivals."""
    spark = envelopes.sparkSession
    read = parsed_once(
        envelopes.select(F.col("message_ts").alias("arrived"), payload_text(F.col("value")).alias("_text")),
        json_value(F.col("_text")), "_v",
    )
    file = string_field(F.col("_v"), "file")
    return read.select(file.alias("_file"), "arrived").filter(F.col("_file").isNotNull()).select(
        qualified(spark, F.col("_file")).alias("file_path"), "arrived"
    )


def timed_messages(envelopes: DataFrame) -> DataFrame:
    """``located_messages`` with the time of the envelope as ``sent``, for a watermark."""
    return located_messages(envelopes.withColumn("sent", F.col("message_ts")), ["sent"])


def with_arrivals(messages: DataFrame, arrivals: DataFrame, wait: str = WAIT, lateness: str = "0 seconds") -> DataFrame:
    """Messages (with ``sent``) and ``arrived``, the time of their file's arrival at most ``wait`` before
    or after, or NULL. Messages with a problem wait for nothing and have NULL."""
    spark = messages.sparkSession
    left = messages.withWatermark("sent", lateness).withColumn("own_path", qualified(spark, F.col("fileURL")))
    right = arrivals.withWatermark("arrived", lateness)
    near = (F.col("arrived") >= F.col("sent") - F.expr(f"INTERVAL {wait}")) & (
        F.col("arrived") <= F.col("sent") + F.expr(f"INTERVAL {wait}")
    )
    return left.join(right, (F.col("own_path") == F.col("file_path")) & near, "left_outer").drop("own_path", "file_path")


def start_loads_on_arrival(
    messages: DataFrame,
    arrivals: DataFrame,
    load: ExactNameLoad,
    name: str,
    checkpoint: str,
    wait: str = WAIT,
    lateness: str = "0 seconds",
    every: str | None = None,
) -> StreamingQuery:
    """Loads each message's file once it has arrived; ``messages`` and ``arrivals`` are envelopes. A
    message whose file does not come in time goes to the dead letters. A file that arrives more
    than once within the time is loaded for each of its arrivals."""

    def run(batch: DataFrame, load_id: str) -> str:
        alone = (F.col("problem") == "") & F.col("arrived").isNull()
        problem = F.when(alone, layouts.FILE_NOT_FOUND).otherwise(F.col("problem"))
        return load.run(batch.withColumn("problem", problem), load_id)

    joined = with_arrivals(timed_messages(messages), file_arrivals(arrivals), wait, lateness)
    return run_per_batch(joined, name, checkpoint, run, every)
