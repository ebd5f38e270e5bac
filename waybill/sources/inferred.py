"""Delimited files with a header line, typed by what they contain.

A column is INTEGER if every value is an integer, FLOAT if every value is a number or missing, STRING
otherwise. The kinds form a lattice, INTEGER < FLOAT < STRING, so that what is known of parts of a
file, or of several files, is put together by taking the greater kind: one aggregate judges any
number of columns of any number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.casts import to_float
from waybill.functions.text import identifier

# Texts that stand for a missing value (fixed values).
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
INTEGER_TEXT = r"\A\s*[+-]?[0-9]+\s*\z"
TRUTH_TEXTS = ("True", "TRUE", "true", "False", "FALSE", "false")

LATTICE = ("INTEGER", "FLOAT", "STRING")
"""Kinds from the least to the greatest."""


def _is_missing(text: Column) -> Column:
    return text.isNull() | text.isin(*MISSING_TEXTS)


def _is_integer(text: Column) -> Column:
    # The pattern comes first: a failed cast costs many times as much.
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint").isNotNull()).otherwise(False)


def _is_number(text: Column) -> Column:
    return to_float(text).isNotNull() & ~F.contains(text, F.lit("_"))


def rank_of(text: Column) -> Column:
    """The least kind of the lattice that holds a value, by its place."""
    return (
        F.when(_is_missing(text), 1)  # no integer can be missing
        .when(_is_integer(text), 0)
        .when(_is_number(text), 1)
        .otherwise(2)
    )


def column_facts(text: Column, number: int) -> list[Column]:
    """What an aggregate has to know of a column: the greatest rank, and whether it can be told that
    all its values are truth values (which have no declared kind)."""
    return [
        F.max(rank_of(text)).alias(f"rank{number}"),
        F.bool_and(text.isin(*TRUTH_TEXTS)).alias(f"truths{number}"),
    ]


def kind_of_facts(rank: Column) -> Column:
    """The kind of a column; one without any value is text."""
    kinds = F.array(*[F.lit(k) for k in LATTICE])
    return F.get(kinds, F.coalesce(rank, F.lit(len(LATTICE) - 1)))


def infer_kinds(strings: DataFrame) -> dict[str, str]:
    """Declared kind per text column; a column of truth values has none and is an error."""
    names = strings.columns
    facts = [fact for i, n in enumerate(names) for fact in column_facts(F.col(identifier(n)), i)]
    found = strings.agg(*facts).first()
    for i, name in enumerate(names):
        if found[f"truths{i}"]:
            raise ValueError(f"column {name}: truth values have no declared kind")
    return {n: LATTICE[found[f"rank{i}"] if found[f"rank{i}"] is not None else -1] for i, n in enumerate(names)}


def value_of(text: Column, kind: str) -> Column:
    """A text as the value of a column of this kind."""
    if kind == "STRING":
        return F.coalesce(text, F.lit(""))
    if kind == "INTEGER":
        return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))
    return F.when(~_is_missing(text), to_float(text))


_QUOTED = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*)'


def delimited_fields(line: Column) -> Column:
    """The fields of a line, where a field in double quotes may hold commas and doubled quotes."""
    parts = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_QUOTED), F.lit(1))

    def plain(part: Column) -> Column:
        quoted = F.startswith(part, F.lit('"')) & F.endswith(part, F.lit('"')) & (F.length(part) > 1)
        inside = F.substr(part, F.lit(2), F.length(part) - 2)
        return F.when(quoted, F.replace(inside, F.lit('""'), F.lit('"'))).otherwise(part)

    return F.when(F.contains(line, F.lit('"')), F.transform(parts, plain)).otherwise(F.split(line, ","))


def header_names(fields: Column) -> Column:
    """Column names of a header line: an empty one is named by its place, and of names that are the
    same but for their case each gets its place added."""
    lower = F.transform(fields, F.lower)

    def named(name: Column, i: Column) -> Column:
        again = F.size(F.filter(lower, lambda other: other == F.lower(name))) > 1
        place = i.cast("string")
        return F.when(name == "", F.concat(F.lit("_c"), place)).when(again, F.concat(name, place)).otherwise(name)

    return F.transform(fields, named)
