"""Text to typed values with the acceptance rules of the declared kinds.

NULL means "does not cast". A pattern decides first: ``try_cast`` alone raises and catches
an exception inside for every bad value, which is some fifty times slower than the
pattern, and it takes number syntax (``1.5d``, ``0x1p3``) that the kinds do not have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 19 digits are the most that can fit.
_INTEGER = r"^\s*[+-]?0*[0-9]{1,19}\s*\z"
_FLOAT = (
    r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
    r"|^\s*([+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*\z"
)
# Digits may be grouped by single underscores.
_STRAY_UNDERSCORE = r"(^|[^0-9])_|_([^0-9]|\z)"

# Texts that cast for certain; others may cast as well.
_PLAIN = {
    "INTEGER": r"\s*[+-]?[0-9]{1,18}\s*",
    "FLOAT": r"\s*[+-]?[0-9]{1,15}(?:\.[0-9]{0,15})?\s*",
}


def _matching(text: Column, pattern: str, spark_type: str) -> Column:
    grouped = F.contains(text, F.lit("_")) & ~text.rlike(_STRAY_UNDERSCORE)
    plain = F.when(grouped, F.replace(text, F.lit("_"), F.lit(""))).otherwise(text)
    return F.when(plain.rlike(pattern), plain.try_cast(spark_type))


def to_integer(text: Column) -> Column:
    """BIGINT or NULL. Accepts blanks around, a sign and ``1_000``; not ``12.0``, ``1e3``."""
    return _matching(text, _INTEGER, "bigint")


def to_float(text: Column) -> Column:
    """DOUBLE or NULL. Accepts ``nan``, ``inf``, exponents and ``1_0.5``; not ``1.5d``, ``0x1``."""
    return _matching(text, _FLOAT, "double")


def cast_text(text: Column, kind: str) -> Column:
    """The text as a value of a declared kind, NULL where it does not cast."""
    if kind == "INTEGER":
        return to_integer(text)
    if kind == "FLOAT":
        return to_float(text)
    if kind == "STRING":
        return text
    raise ValueError(f"unknown kind {kind!r}")


def plain_line(kinds: Sequence[str], separator: str = ",") -> str:
    """Pattern of lines with exactly these fields, all of which cast for certain."""
    anything = f"[^{separator}]*"
    return "^" + separator.join(_PLAIN.get(kind, anything) for kind in kinds) + r"\z"
