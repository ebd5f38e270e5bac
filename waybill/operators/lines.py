"""Lines with their message: attaching, judging, typing."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill import layouts
from waybill.functions.casts import cast_text, to_float, to_integer
from waybill.functions.text import split_fields
from waybill.layouts import Registry
from waybill.operators.joins import LINE_SALTS, Size, attach
from waybill.operators.messages import LINE_CONTEXT

JUDGED_COLUMNS = ("message_id", "message_ts", "destination", "source_file", "layout", "line", "stacktrace")


def attach_messages(lines: DataFrame, bridge: DataFrame, size: Size | None = None) -> DataFrame:
    """Every line with every message that names its file.

    ``bridge`` has ``file_path`` and the message columns, one row per message and file.
    """
    context = bridge.select("file_path", *LINE_CONTEXT)
    return attach(lines, context, ["file_path"], "inner", size, LINE_SALTS).drop("file_path")


def _field(position: int) -> Column:
    return F.get("fields", F.lit(position))


def _is_plain() -> Column:
    """True for lines with the right number of fields that all cast, where the message knows one
    pattern that can tell without taking them apart. False decides nothing.

    It does not pay where the fields are needed anyway (there is a predicate) or where
    counting them is enough (all of them are text).
    """
    return F.coalesce(F.regexp_like("line", F.col("plain_line")), F.lit(False))


def _bad_cast(registry: Registry) -> Column:
    """True where some declared field does not cast. The line knows its kinds by their initials, so
    there is a test per position and kind, however many layouts there are."""
    places = {
        (i, layouts.kind_of(column.dataType)) for layout in registry.sources for i, column in enumerate(layout.schema.fields)
    }
    tests = [
        (F.substr("kinds", F.lit(i + 1), F.lit(1)) == kind[0]) & cast_text(_field(i), kind).isNull()
        for i, kind in sorted(places)
        if kind != "STRING"
    ]
    return reduce(Column.__or__, tests, F.lit(False))


def outside(key: Column, lower: Column, upper: Column) -> Column:
    """True where the key is not strictly between the bounds. A NULL bound excludes
    nothing; NaN on either side never excludes."""
    return F.coalesce(lower >= key, F.lit(False)) | F.coalesce(upper <= key, F.lit(False))


def _out_of_range() -> Column:
    """The predicate of the message, on the key values of ``_with_key``."""
    floating = F.col("_key_double")
    return (
        F.when(F.col("key_kind") == "INTEGER", outside(F.col("_key_long"), F.col("lower_long"), F.col("upper_long")))
        .when(
            F.col("key_kind") == "FLOAT",
            ~F.isnan(floating) & outside(floating, F.col("lower_double"), F.col("upper_double")),
        )
        .when(F.col("key_kind") == "STRING", outside(F.col("_key"), F.col("lower"), F.col("upper")))
        .otherwise(F.lit(False))
    )


def _with_key(lines: DataFrame) -> DataFrame:
    """The line's value of the predicate column; which field that is, the message knows."""
    key = F.get("fields", F.col("key_position"))
    return lines.withColumn("_key", key).withColumns(
        {
            "_key_long": F.when(F.col("key_kind") == "INTEGER", to_integer(F.col("_key"))),
            "_key_double": F.when(F.col("key_kind") == "FLOAT", to_float(F.col("_key"))),
        }
    )


def judge_lines(lines: DataFrame, registry: Registry, on_cast_error: str = "reject") -> DataFrame:
    """Adds ``stacktrace``: the first reason against the line, ``""`` if there is none.

    Order: field count, casts, range predicate. ``on_cast_error="fail"`` stops the job at
    a value that does not cast instead of rejecting its line.
    """
    if on_cast_error not in ("reject", "fail"):
        raise ValueError(f"on_cast_error: {on_cast_error!r}")
    bad_cast = F.lit(layouts.BAD_CAST)
    if on_cast_error == "fail":
        bad_cast = F.raise_error(
            F.concat(F.lit("value does not cast in "), "source_file", F.lit(": "), "line")
        ).cast("string")
    unsettled = ~F.col("_plain")
    reason = (
        F.when(unsettled & (F.size("fields") != F.col("n_fields")), F.lit(layouts.WRONG_FIELD_COUNT))
        .when(unsettled & _bad_cast(registry), bad_cast)
        .when(_out_of_range(), F.lit(layouts.OUT_OF_RANGE))
        .otherwise(F.lit(""))
    )
    return (
        lines.withColumn("_plain", _is_plain())
        .withColumn("fields", F.when(unsettled, split_fields(F.col("line"))))
        .transform(_with_key)
        # The one-element explode keeps later filters on the reason above it. Pushed below,
        # the reason would be worked out twice, splitting the line again for every field.
        .withColumn("stacktrace", F.explode(F.array(reason)))
        .select(*JUDGED_COLUMNS)
    )


def _known_to_cast(text: Column, kind: str) -> Column:
    if kind == "STRING":
        return text
    return F.coalesce(text.try_cast(layouts.SPARK_TYPES[kind]), cast_text(text, kind))


def typed_columns(valid: DataFrame, schema: T.StructType, registry: Registry) -> DataFrame:
    """Valid lines as the columns of a target table.

    Columns are found by name, whatever the case, in the layout of the line; fields the
    table does not know are dropped and columns the file does not have are NULL.
    """
    columns = []
    for target in schema.fields:
        value = F.lit(None).cast(target.dataType)
        # A branch per place and kind of the column, however many layouts have it there.
        places = defaultdict(list)
        for layout in registry.sources:
            own = {source.name.lower(): (i, layouts.kind_of(source.dataType)) for i, source in enumerate(layout.schema.fields)}
            if target.name.lower() in own:
                places[own[target.name.lower()]].append(layout.prefix)
        for (i, kind), prefixes in places.items():
            typed = _known_to_cast(_field(i), kind).cast(target.dataType)
            value = F.when(F.col("layout").isin(prefixes), typed).otherwise(value)
        columns.append(value.alias(target.name))
    return valid.withColumn("fields", split_fields(F.col("line"))).select(*columns)


def named_fields(
    lines: DataFrame,
    file_name: Column,
    by_name: dict[str, T.StructType],
    default: str,
    name: str | None = None,
) -> DataFrame:
    """Lines as untyped columns, the layout found by the *exact* file name.

    Unknown names take the ``default`` layout. Only the lines of the layout ``name``
    (default: the default layout) are given back, since layouts differ in their columns.
    Surplus fields are ignored; missing ones are NULL.
    """
    known = F.array(*[F.lit(n) for n in by_name])
    chosen = F.when(F.array_contains(known, file_name), file_name).otherwise(F.lit(default))
    wanted = name or default
    return (
        lines.filter(chosen == wanted)
        .withColumn("fields", split_fields(F.col("line")))
        .select(
            *[c for c in lines.columns if c != "line"],
            *[_field(i).alias(n) for i, n in enumerate(by_name[wanted].names)],
        )
    )
