"""Where a message goes: stream or batch by file size, a table by its content or topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill import layouts
from waybill.functions.payload import CORRUPT, decode_event, parse_json, parsed_once, payload_text
from waybill.functions.text import utc_text
from waybill.layouts import BATCH_SIZE_THRESHOLD, JSON_LOG_SCHEMA, MESSAGE_SCHEMA
from waybill.operators.messages import TABLE_NAME

STREAM, BATCH = "stream", "batch"
ORIGIN = ("_message_id", "_message_ts")


def size_route(length: Column, threshold: int = BATCH_SIZE_THRESHOLD) -> Column:
    """``stream`` for files below the threshold, else ``batch``."""
    return F.when(length < threshold, STREAM).otherwise(BATCH)


def route_by_size(messages: DataFrame, sizes: DataFrame, threshold: int = BATCH_SIZE_THRESHOLD) -> DataFrame:
    """Messages with ``length`` and ``route``; the whole message is kept on both routes.

    ``sizes`` has ``fileURL, length``, one row per file; a URL with several files counts
    with their sum, and one without a file has NULL in both columns. The sums arrive
    partitioned by URL, and adaptive execution broadcasts them if they turn out small.
    """
    total = sizes.groupBy("fileURL").agg(F.sum("length").alias("length"))
    routed = messages.join(total, ["fileURL"], "left")
    return routed.withColumn("route", F.when(F.col("length").isNotNull(), size_route(F.col("length"), threshold)))


def event_messages(events: DataFrame) -> DataFrame:
    """Base64 trigger events (``data, message_id, message_ts``) to messages."""
    decoded = events.select("message_id", "message_ts", decode_event(F.col("data")).alias("message"))
    return parsed_once(decoded, parse_json(F.col("message"), MESSAGE_SCHEMA), "_m").select(
        "message_id",
        "message_ts",
        "message",
        *[F.col(f"_m.{n}").alias(n) for n in MESSAGE_SCHEMA.names],
        F.when(F.col(f"_m.{CORRUPT}").isNull() & F.col("_m.fileURL").isNotNull(), "")
        .otherwise(layouts.INVALID_MESSAGE)
        .alias("problem"),
    )


def origin_of(envelopes: DataFrame) -> list[Column]:
    """The columns ``ORIGIN``; NULL where the envelopes have no such column."""
    kinds = dict(envelopes.dtypes)
    number = F.col("message_id") if "message_id" in kinds else F.lit(None)
    time = F.lit(None)
    if "message_ts" in kinds:
        time = F.col("message_ts")
        if kinds["message_ts"] != "string":
            time = utc_text(time, kinds["message_ts"] == "timestamp")
    return [number.cast("string").alias(ORIGIN[0]), time.cast("string").alias(ORIGIN[1])]


def rows_with_target(
    envelopes: DataFrame,
    schema: T.StructType = JSON_LOG_SCHEMA,
    field: str = "target_table",
    keep_field: bool = False,
    with_origin: bool = False,
) -> DataFrame:
    """JSON payloads to rows of ``schema`` plus ``target`` (the table named inside) and
    ``problem``; the routing field is no column of the row unless ``keep_field``.
    ``with_origin`` adds the envelope's id and time (see ``ORIGIN``).

    Tables are told apart like the catalog does, whatever the case of their names.
    """
    text = payload_text(F.col("value"))
    with_target = T.StructType([*schema.fields, T.StructField(field, T.StringType())])
    origin = origin_of(envelopes) if with_origin else []
    parsed = parsed_once(envelopes.select(*origin, text.alias("message")), parse_json(F.col("message"), with_target), "_r")
    target = F.col(f"_r.{field}")
    problem = (
        F.when(F.col(f"_r.{CORRUPT}").isNotNull() | target.isNull(), layouts.INVALID_MESSAGE)
        .when(~target.rlike(TABLE_NAME), layouts.INVALID_TABLE_NAME)
        .otherwise("")
    )
    return parsed.select(
        *[F.col(f"_r.{n}").alias(n) for n in (with_target if keep_field else schema).names],
        F.lower(target).alias("target"),
        "message",
        problem.alias("problem"),
        *(ORIGIN if with_origin else ()),
    )


def rows_by_topic(
    envelopes: DataFrame,
    roads: Mapping[str, str],
    schema: T.StructType = JSON_LOG_SCHEMA,
    with_origin: bool = False,
) -> DataFrame:
    """JSON payloads to rows plus ``target``, the table of their topic; messages of other
    topics are not on any road and are left out."""
    text = payload_text(F.col("value"))
    target = F.lit(None).cast("string")
    for topic, table in roads.items():
        target = F.when(F.col("topic") == topic, F.lit(table)).otherwise(target)
    parsed = envelopes.filter(F.col("topic").isin(*roads)).select(
        *(origin_of(envelopes) if with_origin else []), text.alias("message"), target.alias("target")
    )
    return parsed_once(parsed, parse_json(F.col("message"), schema), "_r").select(
        *[F.col(f"_r.{n}").alias(n) for n in schema.names],
        "target",
        "message",
        F.when(F.col(f"_r.{CORRUPT}").isNotNull(), layouts.INVALID_MESSAGE).otherwise("").alias("problem"),
        *(ORIGIN if with_origin else ()),
    )
