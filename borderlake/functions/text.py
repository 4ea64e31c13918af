"""Reading raw text cells the way Python's ``str`` and ``float`` would."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Number spellings that Python's int() and float() accept (ASCII).
INTEGER = r"\A[+-]?[0-9]+(_[0-9]+)*\z"
NUMBER = (
    r"\A[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)"
    r"([eE][+-]?[0-9]+(_[0-9]+)*)?\z"
)
NOT_A_NUMBER = r"(?i)\A[+-]?nan\z"
POSITIVE_INFINITY = r"(?i)\A\+?inf(inity)?\z"
NEGATIVE_INFINITY = r"(?i)\A-inf(inity)?\z"


def cell(name: str) -> Column:
    """Text of a raw cell without surrounding whitespace; a missing cell reads as empty."""
    return F.coalesce(F.btrim(F.col(f"`{name}`"), F.lit(WHITESPACE)), F.lit(""))


def digits_only(col: Column) -> Column:
    """Drop the underscores Python allows between digits."""
    return F.replace(col, F.lit("_"), F.lit(""))


def ordered_number(text: Column) -> Column:
    """``float(text)`` as a double; NULL where Python would raise, and for NaN,
    which Python orders neither above nor below anything.

    A plain cast is laxer: it reads ``1.0d`` and ``0x1p3`` as numbers.
    """
    return (
        F.when(text.rlike(NUMBER), digits_only(text).try_cast("double"))
        .when(text.rlike(POSITIVE_INFINITY), F.lit(float("inf")))
        .when(text.rlike(NEGATIVE_INFINITY), F.lit(float("-inf")))
    )


def number(text: Column) -> Column:
    """``float(text)`` as a double, NULL where Python would raise."""
    return F.when(text.rlike(NOT_A_NUMBER), F.lit(float("nan"))).otherwise(ordered_number(text))


def is_number(text: Column) -> Column:
    return text.rlike(NUMBER) | text.rlike(NOT_A_NUMBER) | text.rlike(POSITIVE_INFINITY) | text.rlike(NEGATIVE_INFINITY)


def number_text(value: Column) -> Column:
    """A double printed as Python prints it.

    Both print the shortest digits that round-trip; they differ in when they
    switch to scientific notation and in how they write the exponent.
    """
    java = value.cast("string")
    size = F.abs(value)
    fixed = F.regexp_replace(java.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .when(~java.contains("E"), java)
        .when((size >= 1e-4) & (size < 1e16), fixed)
        .otherwise(scientific)
    )
