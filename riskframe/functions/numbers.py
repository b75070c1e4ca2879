"""Lenient number parsing and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^ *[+-]?[0-9]+ *$"
# Whole numbers from 1 to 2147483647.
_POSITIVE = (
    r"^ *\+?0*([1-9][0-9]{0,8}|1[0-9]{9}|20[0-9]{8}|21[0-3][0-9]{7}|214[0-6][0-9]{6}"
    r"|2147[0-3][0-9]{5}|21474[0-7][0-9]{4}|214748[0-2][0-9]{3}|2147483[0-5][0-9]{2}"
    r"|21474836[0-3][0-9]|214748364[0-7]) *$"
)
_DECIMAL = r"^ *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)? *$"

# A lenient cast raises and catches an error for every bad value, which is slow
# on dirty columns; the patterns keep bad values away from it.


def parse_int(c: Column) -> Column:
    """Integer with optional sign and outer blanks; anything else is null."""
    return F.when(c.rlike(_INTEGER), c.try_cast("int"))


def at_least_one(c: Column) -> Column:
    """Whether a count text is a whole number of one or more; null stays null."""
    return c.rlike(_POSITIVE)


def parse_double(c: Column) -> Column:
    """Plain decimal number; null for words, ``NaN`` and type suffixes."""
    return F.when(c.rlike(_DECIMAL), c.try_cast("double"))


def decimal_point(c: Column) -> Column:
    """Write both decimal marks seen in road positions as a point."""
    return F.translate(c, ",+", "..")


def parse_km(c: Column, scale: int = 0, blank: str = "zero") -> Column:
    """Road position as a decimal.

    ``scale=0`` rounds to whole kilometres.  ``blank='zero'`` puts an unknown
    position at kilometre 0; ``blank='null'`` keeps it unknown.
    """
    if blank not in ("zero", "null"):
        raise ValueError("blank must be 'zero' or 'null'")
    text = F.trim(c)
    if blank == "zero":
        text = F.coalesce(F.nullif(text, F.lit("")), F.lit("0"))
    return parse_double(decimal_point(text)).try_cast(f"decimal(10,{scale})")


def ratio(num: Column, den: Column) -> Column:
    """Division that is null, not an error, on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def null_to_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("double"))
