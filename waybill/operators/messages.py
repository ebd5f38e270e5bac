"""Control messages: parsing, checking, and everything that is known before reading.

Frames of messages carry ``message_id``, ``message_ts``, the message fields and
``problem``: the reason why the message cannot be loaded, or ``""``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waybill import layouts
from waybill.functions.casts import plain_line, to_float
from waybill.functions.payload import (
    CORRUPT,
    has_only_keys,
    json_value,
    parse_json,
    parsed_once,
    payload_text,
    string_field,
)
from waybill.functions.text import SEPARATOR, base_name, utc_text
from waybill.layouts import MESSAGE_SCHEMA, Registry

REQUIRED_KEYS = ("fileURL", "destination")
PREDICATE_KEYS = ("partition_depth", "partition_key")
ALIASED_KEYS = ("address", "destination")
TABLE_NAME = r"\A[A-Za-z0-9_]+\z"

_LONG_MAX = 2**63 - 1
_LONG_MIN = -(2**63)

MESSAGES_FRAME_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("message_ts", T.StringType()),
        *MESSAGE_SCHEMA.fields,
    ]
)


def parse_messages(envelopes: DataFrame, strict_keys: bool = False) -> DataFrame:
    """Envelopes (``value, message_id, message_ts``) to messages.

    A message that is no JSON object, or whose URL or destination is missing or not text,
    gets the problem ``invalid_message_format``; with ``strict_keys`` so does one with a
    key nobody knows. Each message is parsed once as it is declared and once as it is written.
    """
    text = payload_text(F.col("value"))
    parsed = envelopes.select(F.col("message_id").cast("string").alias("message_id"), "message_ts", text.alias("message"))
    parsed = parsed_once(parsed, parse_json(F.col("message"), MESSAGE_SCHEMA), "_m")
    value = F.col("_v")
    valid = reduce(Column.__and__, [string_field(value, key).isNotNull() for key in REQUIRED_KEYS])
    if strict_keys:
        valid &= has_only_keys(value, REQUIRED_KEYS, PREDICATE_KEYS)
    well_formed = F.coalesce(valid, F.lit(False)) & F.col(f"_m.{CORRUPT}").isNull()
    return parsed_once(parsed, json_value(F.col("message")), "_v").select(
        "message_id",
        "message_ts",
        "message",
        *[F.col(f"_m.{name}").alias(name) for name in MESSAGE_SCHEMA.names],
        F.when(well_formed, F.lit("")).otherwise(layouts.INVALID_MESSAGE).alias("problem"),
    )


def located_messages(envelopes: DataFrame, also: Iterable[str] = ()) -> DataFrame:
    """Messages of exactly a URL (``fileURL``, or ``address``) and a destination, all text, parsed
    once: ``message_id, message_ts, message, fileURL, destination, problem``, and the columns
    ``also`` of the envelopes."""
    text = payload_text(F.col("value"))
    number = F.col("message_id").cast("string").alias("message_id")
    own = with_text_time(envelopes).select(number, "message_ts", text.alias("message"), *also)
    value = F.col("_v")
    url = F.when(has_only_keys(value, REQUIRED_KEYS), string_field(value, "fileURL")).when(
        has_only_keys(value, ALIASED_KEYS), string_field(value, "address")
    )
    read = parsed_once(own, json_value(F.col("message")), "_v").select(
        "message_id", "message_ts", "message", url.alias("fileURL"), string_field(value, "destination").alias("destination"), *also
    )
    complete = F.col("fileURL").isNotNull() & F.col("destination").isNotNull()
    problem = F.when(~complete, layouts.INVALID_MESSAGE).when(
        ~F.col("destination").rlike(TABLE_NAME), layouts.INVALID_TABLE_NAME
    )
    return read.withColumn("problem", F.coalesce(problem, F.lit("")))


def messages_frame(spark: SparkSession, messages: Iterable[Mapping]) -> DataFrame:
    """Messages given as parameters (``fileURL, destination, timestamp, id`` and, if wanted,
    ``partition_depth, partition_key``), for batch loads."""
    rows = [
        {
            **{k: m.get(k) for k in MESSAGE_SCHEMA.names},
            "message_id": str(m["id"]),
            "message_ts": str(m["timestamp"]),
            "partition_depth": None
            if m.get("partition_depth") is None
            else [str(bound) for bound in m["partition_depth"]],
        }
        for m in messages
    ]
    return spark.createDataFrame(
        pa.Table.from_pylist(rows, to_arrow_schema(MESSAGES_FRAME_SCHEMA)), MESSAGES_FRAME_SCHEMA
    )


def with_problem(messages: DataFrame) -> DataFrame:
    """Messages given as parameters with the columns of parsed ones: their text, and no problem."""
    if "problem" not in messages.columns:
        messages = messages.withColumn("problem", F.lit(""))
    if "message" not in messages.columns:
        fields = F.struct(*[F.col(n) for n in MESSAGE_SCHEMA.names if n in messages.columns])
        messages = messages.withColumn("message", F.to_json(fields))
    return messages


def with_text_time(messages: DataFrame) -> DataFrame:
    """``message_ts`` as the text that the tables store; text given by the caller stays."""
    kind = messages.schema["message_ts"].dataType
    if kind == T.StringType():
        return messages
    return messages.withColumn("message_ts", utc_text(F.col("message_ts"), kind == T.TimestampType()))


_ENTRY = T.StructType(
    [
        T.StructField("prefix", T.StringType()),
        T.StructField("is_text", T.BooleanType()),
        T.StructField("names", T.ArrayType(T.StringType())),
        T.StructField("kinds", T.ArrayType(T.StringType())),
        T.StructField("plain", T.StringType()),
    ]
)
_PATTERN_CHARACTER = re.compile(r"[\\^$.|?*+()\[\]{}]")


def layout_entries(registry: Registry) -> Column:
    """The layouts of a registry in their order, as one constant: a plan that looks layouts up does
    not grow with their number."""
    entries = []
    for layout in registry.sources:
        kinds = [layouts.kind_of(f.dataType) for f in layout.schema.fields]
        entry = {
            "prefix": layout.prefix,
            "is_text": not _PATTERN_CHARACTER.search(layout.prefix),
            "names": layout.schema.names,
            "kinds": kinds,
        }
        if set(kinds) != {"STRING"}:
            entry["plain"] = plain_line(kinds, SEPARATOR)
        entries.append(entry)
    return F.from_json(F.lit(json.dumps(entries)), T.ArrayType(_ENTRY))


def entry_of(file_name: Column, registry: Registry) -> Column:
    """The first layout that matches the start of a file name, as an entry, or NULL. Prefixes without
    pattern characters are compared as text."""

    def fits(entry: Column) -> Column:
        return F.when(entry["is_text"], F.startswith(file_name, entry["prefix"])).otherwise(
            F.regexp_like(file_name, F.concat(F.lit("^(?:"), entry["prefix"], F.lit(")")))
        )

    return F.get(F.filter(layout_entries(registry), fits), F.lit(0))


def layout_of(file_name: Column, registry: Registry) -> Column:
    """Prefix of the first layout that matches the start of a file name, or NULL."""
    return entry_of(file_name, registry)["prefix"]


def _lower_long(bound: Column) -> Column:
    """Greatest integer not above the bound; NULL excludes nothing."""
    number = to_float(bound)
    exact = F.floor(bound.try_cast("decimal(38,18)")).try_cast("bigint")
    return F.when(~F.isnan(number), F.coalesce(exact, F.when(number > 0, F.lit(_LONG_MAX))))


def _upper_long(bound: Column) -> Column:
    """Smallest integer not below the bound; NULL excludes nothing."""
    number = to_float(bound)
    exact = F.ceil(bound.try_cast("decimal(38,18)")).try_cast("bigint")
    return F.when(~F.isnan(number), F.coalesce(exact, F.when(number < 0, F.lit(_LONG_MIN))))


def prepare_messages(messages: DataFrame, registry: Registry) -> DataFrame:
    """Adds what the lines will need: file name, layout, typed bounds; and the problems
    of the message with respect to the registry.

    The range predicate is there only if both bounds and key are.
    """
    messages = with_text_time(with_problem(messages))
    key, bounds = F.col("partition_key"), F.col("partition_depth")
    messages = messages.withColumn("source_file", base_name(F.col("fileURL")))
    messages = parsed_once(messages, entry_of(F.col("source_file"), registry), "_entry")
    entry, layout = F.col("_entry"), F.col("layout")
    messages = messages.withColumn("layout", entry["prefix"])
    has_predicate = key.isNotNull() & bounds.isNotNull()
    place = F.array_position(entry["names"], key).cast("int") - 1
    key_position = F.when(has_predicate & (place >= 0), place)
    messages = messages.withColumns(
        {
            "n_fields": F.when(layout.isNotNull(), F.size(entry["names"])),
            "kinds": F.array_join(F.transform(entry["kinds"], lambda k: F.left(k, F.lit(1))), ""),
            # One pattern per line pays where there is no predicate and some field has to cast.
            "plain_line": F.when(key_position.isNull(), entry["plain"]),
            "key_kind": F.get(entry["kinds"], key_position),
            "key_position": key_position,
            "lower": F.when(has_predicate, F.get(bounds, F.lit(0))),
            "upper": F.when(has_predicate, F.get(bounds, F.lit(1))),
        }
    )
    lower, upper, kind = F.col("lower"), F.col("upper"), F.col("key_kind")
    bad_bounds = lower.isNull() | upper.isNull() | (
        (kind != "STRING") & (to_float(lower).isNull() | to_float(upper).isNull())
    )
    known_tables = F.array(*[F.lit(t) for t in registry.tables]).cast("array<string>")
    problem = (
        F.when(F.col("problem") != "", F.col("problem"))
        .when(layout.isNull(), layouts.NO_LAYOUT)
        .when(~F.array_contains(known_tables, F.col("destination")), layouts.UNKNOWN_DESTINATION)
        .when(has_predicate & kind.isNull(), layouts.UNKNOWN_KEY)
        .when(has_predicate & bad_bounds, layouts.INVALID_BOUNDS)
        .otherwise("")
    )
    return messages.withColumns(
        {
            "problem": problem,
            "lower_long": F.when(kind == "INTEGER", _lower_long(lower)),
            "upper_long": F.when(kind == "INTEGER", _upper_long(upper)),
            "lower_double": F.when((kind == "FLOAT") & ~F.isnan(to_float(lower)), to_float(lower)),
            "upper_double": F.when((kind == "FLOAT") & ~F.isnan(to_float(upper)), to_float(upper)),
        }
    ).drop("_entry")


LINE_CONTEXT = (
    "message_id",
    "message_ts",
    "source_file",
    "destination",
    "layout",
    "n_fields",
    "kinds",
    "plain_line",
    "key_position",
    "key_kind",
    "lower",
    "upper",
    "lower_long",
    "upper_long",
    "lower_double",
    "upper_double",
)
"""Message columns a line is judged and routed by."""
