"""JSON payloads of topic messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def payload_text(value: Column) -> Column:
    """Message bytes (or text) as UTF-8 text."""
    return value.cast("string")


def decode_event(data: Column) -> Column:
    """Text inside a base64 event body."""
    return F.unbase64(data).cast("string")


def parse_json(text: Column, schema: T.StructType) -> Column:
    """Struct of the declared fields plus ``_corrupt`` (the text, if it does not parse)."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(text, with_corrupt, options)


def json_field(text: Column, name: str) -> Column:
    """One top-level field of a JSON object as text."""
    return F.get_json_object(text, f"$.{name}")


def parsed_once(df: DataFrame, column: Column, name: str) -> DataFrame:
    """The frame with a parsed value that is worked out once a row, however often its parts are used.

    The one-element explode is what the optimizer does not look through: without it, every use of a
    field becomes a parse of its own.
    """
    return df.withColumn(name, F.explode(F.array(column)))


def json_value(text: Column) -> Column:
    """The text as a VARIANT, NULL if it is no JSON."""
    return F.try_parse_json(text)


def string_field(value: Column, name: str) -> Column:
    """A top-level field of a parsed object if it is a JSON string, else NULL (``from_json`` alone
    would turn a number into text)."""
    found = F.try_variant_get(value, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(value, f"$.{name}", "string"))


def has_only_keys(value: Column, required: Iterable[str], optional: Iterable[str] = ()) -> Column:
    """True if the parsed object has every required key and no key outside the two lists."""
    required, optional = list(required), list(optional)
    keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
    needed = F.array(*[F.lit(k) for k in required])
    allowed = F.array(*[F.lit(k) for k in required + optional])
    only = (F.size(F.array_except(needed, keys)) == 0) & (F.size(F.array_except(keys, allowed)) == 0)
    return F.coalesce(only, F.lit(False))
