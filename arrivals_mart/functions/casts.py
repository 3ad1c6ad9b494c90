"""Tolerant typing of raw text / floating point columns.

Raw CSV columns arrive as strings and arrival codes as doubles. Spark 4 runs
with ANSI casts, where ``int('')`` or ``int('12.0')`` fail the whole job; the
source data expects malformed values to become null and doubles to be
truncated towards zero. Every helper is a built-in expression (``try_cast``),
so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrivals_mart.functions._cols import as_col


# What int(text) takes: an optionally signed decimal number, blanks around it. Type
# suffixes ('64D') and exponents ('1e3') are no integers, though double(text) reads them.
_NUMBER_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\s*$"


def _plain_number(c: Column) -> Column:
    """False for text that is no plain number; folded to true for other types."""
    return (F.typeof(c) != "string") | c.cast("string").rlike(_NUMBER_TEXT)


def _tolerant_integral(c, kind: str) -> Column:
    # integral types and digits convert exactly, and need no pattern; only fractions go through double
    c = as_col(c)
    return F.coalesce(c.try_cast(kind), F.when(_plain_number(c), tolerant_double(c).try_cast(kind)))


def tolerant_double(c) -> Column:
    """Text or number -> double; junk, empty and out-of-range text -> null."""
    return as_col(c).try_cast("double")


def tolerant_int(c) -> Column:
    """Text or number -> int, truncating fractions ('12.7' -> 12); junk -> null."""
    return _tolerant_integral(c, "int")


def tolerant_long(c) -> Column:
    """Like :func:`tolerant_int` with a 64-bit result, for keys that outgrow int."""
    return _tolerant_integral(c, "bigint")


def tolerant_date(c) -> Column:
    """Text -> date ('yyyy-MM-dd' and longer ISO forms); junk -> null."""
    return as_col(c).try_cast("date")


def int_key(c) -> Column:
    """Numeric code -> text key without the fraction: 6.0 -> '6'; null stays null.

    The record key arrives as a double, a bigint or text. It is truncated
    through a 64-bit integer, so keys beyond 2^31 keep their value, and
    integral keys beyond 2^53 too.
    """
    return tolerant_long(c).cast("string")


def as_date_literal(value: str) -> Column:
    return F.lit(value).cast("date")
