"""Clock text to seconds of day, day parts and calendar fields.

A time of day is an integer number of seconds: it wraps, compares and buckets
without depending on a TIME type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86_400
HALF_DAY = DAY // 2
_TIME = r"^ *([0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:\.[0-9]{1,7})?)?) *$"
# A closing h, AM or PM together with every earlier occurrence of the same mark.
_SUFFIX = r"(?i)h(?=.*h$)|h$|am(?=.*am$)|am$|pm(?=.*pm$)|pm$"
_EPOCH = "1970-01-01 "


def seconds_of_day(c: Column) -> Column:
    """``h:mm`` or ``h:mm:ss`` in 24-hour form; null when it is not a time."""
    stamp = F.concat(F.lit(_EPOCH), F.regexp_extract(c, _TIME, 1)).try_cast("timestamp_ntz")
    start = F.lit(_EPOCH + "00:00:00").cast("timestamp_ntz")
    whole = F.when(c.rlike(_TIME), stamp)
    return F.timestamp_diff("SECOND", start, whole).cast("int")


def add_hours(seconds: Column, hours: int) -> Column:
    """Shift a time of day, wrapping at midnight."""
    return F.pmod(seconds + F.lit(hours * 3600), F.lit(DAY))


def _bare(c: Column) -> Column:
    return F.regexp_replace(c, _SUFFIX, "")


def _resolve(c: Column, bare: Column, seconds: Column, twelve_am: str) -> Column:
    """Apply the meaning of the suffix to the bare time."""
    if twelve_am not in ("reference", "midnight"):
        raise ValueError("twelve_am must be 'reference' or 'midnight'")
    pm = c.ilike("%PM") & (F.left(bare, F.lit(2)) != "12")
    shift = F.when(pm, HALF_DAY)
    if twelve_am == "midnight":
        shift = shift.when(c.ilike("%AM") & bare.startswith("12"), HALF_DAY)
    in_range = ~c.ilike("%h") | (F.pmod(seconds, F.lit(HALF_DAY)) <= HALF_DAY - 60)
    return F.when(in_range, F.pmod(seconds + shift.otherwise(0), F.lit(DAY)))


def parse_clock(c: Column, twelve_am: str = "reference") -> Column:
    """Cleaned clock text (AM/PM, trailing ``h`` or 24 h) to seconds of day.

    A trailing ``h`` marks a 24-hour time, but the last minute of each half day
    beyond hh:59:00 is out of its range and gives null.  PM adds twelve hours,
    wrapping, unless the text starts with 12.  ``twelve_am='reference'`` leaves
    12:30 AM at half past noon, as the compatible rule does; ``'midnight'``
    gives 00:30.
    """
    bare = _bare(c)
    return _resolve(c, bare, seconds_of_day(bare), twelve_am)


def add_clock(df: DataFrame, source: str, out: str, twelve_am: str = "reference") -> DataFrame:
    """``parse_clock`` in steps, so each text operation runs once per row."""
    bare, at = f"_{out}_bare", f"_{out}_at"
    stepped = df.withColumn(bare, _bare(F.col(source)))
    stepped = stepped.withColumn(at, seconds_of_day(F.col(bare)))
    return stepped.withColumn(
        out, _resolve(F.col(source), F.col(bare), F.col(at), twelve_am)
    ).drop(bare, at)


# Day-part names.
DAYPARTS = ("madrugada", "manha", "vespertino", "noturno")


def daypart(seconds: Column, names: tuple[str, str, str, str] = DAYPARTS) -> Column:
    """Six-hour bucket of a time of day; null stays null."""
    return F.get(F.array(*[F.lit(n) for n in names]), F.floor(seconds / (6 * 3600)).cast("int"))


def parse_day(c: Column, strict: bool = True) -> Column:
    """``dd/MM/yy`` to a date.  Strict raises on bad text, lenient gives null."""
    pattern = "dd/MM/yy"
    return F.to_date(c, pattern) if strict else F.try_to_date(c, pattern)


# Weekday names, Monday first.
WEEKDAYS = (
    "segunda-feira",
    "terça-feira",
    "quarta-feira",
    "quinta-feira",
    "sexta-feira",
    "sábado",
    "domingo",
)


def month_label(day: Column) -> Column:
    return F.date_format(day, "MM")


def weekday_label(day: Column, names: tuple[str, ...] = WEEKDAYS) -> Column:
    """Weekday name from the weekday number, independent of any locale."""
    return F.get(F.array(*[F.lit(n) for n in names]), F.weekday(day))
