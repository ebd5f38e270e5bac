"""What leaves a load: valid rows, reject records, counts, monitoring records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill import layouts
from waybill.functions.text import identifier, list_text
from waybill.layouts import MONITORING_SCHEMA, REJECT_SCHEMA, Registry
from waybill.operators.joins import LINE_SALTS, attach

MESSAGE_KEY = ("message_id", "message_ts")


def is_valid() -> Column:
    return F.col("stacktrace") == ""


def valid_lines(judged: DataFrame) -> DataFrame:
    return judged.filter(is_valid())


def rejected_lines(judged: DataFrame) -> DataFrame:
    return judged.filter(~is_valid())


def reject_records(rejected: DataFrame) -> DataFrame:
    """Rejected lines as reject-table rows, with ``destination`` to route them by."""
    return rejected.select(
        F.col("message_ts").alias("timestamp"),
        "stacktrace",
        "source_file",
        list_text(F.col("line")).alias("raw_data"),
        "destination",
    )


def count_lines(judged: DataFrame, key: Sequence[str] = MESSAGE_KEY) -> DataFrame:
    """Valid and rejected lines per message: one aggregate, combined before the shuffle."""
    return judged.groupBy(*key).agg(
        F.count_if(is_valid()).alias("number_inserted_rows"),
        F.count_if(~is_valid()).alias("number_rejected_rows"),
    )


def cogroup_counts(valid: DataFrame, rejected: DataFrame, key: Sequence[str] = MESSAGE_KEY) -> DataFrame:
    """The same counts from two separate frames; a message missing on one side counts 0."""
    inserted = valid.groupBy(*key).agg(F.count("*").alias("number_inserted_rows"))
    refused = rejected.groupBy(*key).agg(F.count("*").alias("number_rejected_rows"))
    zero = F.lit(0).cast("bigint")
    return inserted.join(refused, list(key), "full_outer").select(
        *key,
        F.coalesce("number_inserted_rows", zero).alias("number_inserted_rows"),
        F.coalesce("number_rejected_rows", zero).alias("number_rejected_rows"),
    )


def end_records(counts: DataFrame) -> DataFrame:
    """SUCCESS, or WARNING as soon as one line was rejected, per message."""
    event = F.when(F.col("number_rejected_rows") != 0, "WARNING").otherwise("SUCCESS")
    return counts.select(
        F.col("message_ts").alias("timestamp"),
        event.alias("event"),
        "number_inserted_rows",
        "number_rejected_rows",
        "message_id",
    )


def start_records(messages: DataFrame) -> DataFrame:
    """START with zero counts per message; use as ``messages.transform(start_records)``."""
    zero = F.lit(0).cast("bigint")
    return messages.select(
        F.col("message_ts").alias("timestamp"),
        F.lit("START").alias("event"),
        zero.alias("number_inserted_rows"),
        zero.alias("number_rejected_rows"),
        "message_id",
    )


def dead_letters(messages: DataFrame) -> DataFrame:
    """Messages with a problem as dead-letter rows."""
    return messages.filter(F.col("problem") != "").select(
        F.col("message_ts").alias("timestamp"),
        F.col("problem").alias("reason"),
        "message_id",
        "message",
    )


def conform(df: DataFrame, schema: T.StructType, unknown: str = "drop") -> DataFrame:
    """The frame as the columns of a table: by name whatever the case, in table order.

    Missing columns are NULL. Columns the table does not know are dropped, or are an
    error with ``unknown="reject"``.
    """
    by_name = {c.lower(): c for c in df.columns}
    extra = set(by_name) - {f.name.lower() for f in schema.fields}
    if extra and unknown == "reject":
        raise ValueError(f"columns unknown to the table: {sorted(extra)}")
    return df.select(
        *[
            (F.col(identifier(by_name[f.name.lower()])) if f.name.lower() in by_name else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def as_rejects(rejected: DataFrame) -> DataFrame:
    return conform(reject_records(rejected), REJECT_SCHEMA)


def as_monitoring(records: DataFrame) -> DataFrame:
    """Monitoring records as table rows; the message id is not part of the table."""
    return conform(records, MONITORING_SCHEMA)


def max_bad_rows(registry: Registry) -> Column:
    """The bad-row limit of the line's layout."""
    limit = F.lit(None).cast("int")
    by_limit: dict[int, list[str]] = {}
    for layout in registry.sources:
        by_limit.setdefault(layout.max_bad_rows, []).append(layout.prefix)
    for rows, prefixes in by_limit.items():
        limit = F.when(F.col("layout").isin(prefixes), F.lit(rows)).otherwise(limit)
    return limit


def files_over_limit(judged: DataFrame, registry: Registry) -> DataFrame:
    """``message_id, message_ts, source_file`` of files with more bad rows than allowed."""
    key = [*MESSAGE_KEY, "source_file", "layout"]
    bad = rejected_lines(judged).groupBy(*key).agg(F.count("*").alias("_bad"))
    return bad.filter(F.col("_bad") > max_bad_rows(registry)).select(*MESSAGE_KEY, "source_file")


def apply_bad_row_limit(judged: DataFrame, over_limit: DataFrame) -> DataFrame:
    """Turns the valid lines of files over the limit into rejects.

    ``over_limit`` comes from ``files_over_limit`` and should be a stored frame, as it is
    measured before it is joined.
    """
    marks = over_limit.withColumn("_over", F.lit(True))
    marked = attach(judged, marks, [*MESSAGE_KEY, "source_file"], "left", salts=LINE_SALTS)
    reason = F.when(is_valid() & F.col("_over"), layouts.TOO_MANY_BAD_ROWS).otherwise(F.col("stacktrace"))
    return marked.withColumn("stacktrace", reason).select(*judged.columns)
