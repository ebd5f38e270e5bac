"""Lines, names, URLs and times as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ","

# Characters that are escaped in list text: controls, formats, unassigned and every
# separator but the plain space.
_NOT_PRINTABLE = r"[[\p{C}\p{Z}]&&[^ ]]"
_NEEDS_CARE = r"['\\]|" + _NOT_PRINTABLE


def split_fields(line: Column) -> Column:
    """Fields between commas: no quoting, no escaping, trailing empties kept."""
    return F.split(line, SEPARATOR)


def last_part(text: Column, separator: str) -> Column:
    """What follows the last separator (the whole text if there is none)."""
    return F.substring_index(text, separator, -1)


def base_name(url: Column) -> Column:
    """File name of a URL."""
    return last_part(url, "/")


def bucket_of(url: Column) -> Column:
    return F.regexp_extract(url, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/]*)", 1)


def object_of(url: Column) -> Column:
    """Everything after the bucket, however deep."""
    return F.regexp_extract(url, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?[^/]*/(.*)$", 1)


def without_scheme(url: Column) -> Column:
    return F.regexp_replace(url, "^gs://", "")


def strip_carriage_return(value: Column) -> Column:
    """Drops the one ``\\r`` that a CRLF line end leaves behind."""
    return F.when(
        F.endswith(value, F.lit("\r")), F.left(value, F.length(value) - 1)
    ).otherwise(value)


def utc_text(ts: Column, zoned: bool = True) -> Column:
    """``2024-01-02 03:04:05`` in UTC, with six more digits when there is a fraction.

    ``zoned=False`` for zone-less timestamps, which are taken as UTC.
    """
    utc = F.to_utc_timestamp(ts, F.current_timezone()) if zoned else ts
    return F.when(
        F.date_format(utc, "SSSSSS") == "000000", F.date_format(utc, "yyyy-MM-dd HH:mm:ss")
    ).otherwise(F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _escaped_char(char: Column) -> Column:
    code = F.ascii(char)
    return (
        F.when(char == "\\", F.lit("\\\\"))
        .when(char == "\t", F.lit("\\t"))
        .when(char == "\n", F.lit("\\n"))
        .when(char == "\r", F.lit("\\r"))
        .when(~char.rlike(_NOT_PRINTABLE), char)
        .when(code <= 0xFF, F.concat(F.lit("\\x"), F.lpad(F.lower(F.hex(code)), 2, "0")))
        .when(code <= 0xFFFF, F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(F.lower(F.hex(code)), 8, "0")))
    )


def _quoted(field: Column) -> Column:
    """One field in single quotes, or in double quotes if it holds only single ones."""
    body = F.array_join(F.transform(F.split(field, ""), _escaped_char), "")
    has_single = F.contains(field, F.lit("'"))
    has_double = F.contains(field, F.lit('"'))
    return (
        F.when(has_single & ~has_double, F.concat(F.lit('"'), body, F.lit('"')))
        .when(has_single, F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))
        .otherwise(F.concat(F.lit("'"), body, F.lit("'")))
    )


def list_text(line: Column) -> Column:
    """The split line as list text, ``['a', 'b']``.

    Lines without quotes, backslashes or unprintable characters need one string
    replacement; only the others are taken apart field by field.
    """
    plain = F.concat(F.lit("['"), F.replace(line, F.lit(SEPARATOR), F.lit("', '")), F.lit("']"))
    careful = F.concat(
        F.lit("["), F.array_join(F.transform(split_fields(line), _quoted), ", "), F.lit("]")
    )
    return F.when(line.rlike(_NEEDS_CARE), careful).otherwise(plain)


def identifier(name: str) -> str:
    """A name as SQL takes it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
