"""Text hygiene as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP, TAB, CR, LF = "\u00a0", "\t", "\r", "\n"
_INVISIBLE = NBSP + TAB + CR + LF


def strip_all(c: Column) -> Column:
    """Remove blanks, no-break blanks, tabs and line ends wherever they stand."""
    return F.translate(c, " " + _INVISIBLE, "")


def strip_invisible(c: Column) -> Column:
    """Remove no-break blanks, tabs and line ends, then trim; inner blanks stay."""
    return F.trim(F.translate(c, _INVISIBLE, ""))


def strip_punctuation(c: Column, marks: str = ".,;/-") -> Column:
    return F.translate(c, marks, "")


def visible_length(c: Column) -> Column:
    """Length that does not count trailing blanks."""
    return F.length(F.rtrim(c))


def before_first(c: Column, token: str) -> Column:
    return F.substring_index(c, token, 1)


def after_first(c: Column, token: str) -> Column:
    """Text behind the first ``token``; the whole text when it is absent."""
    return F.substring(c, F.instr(c, token) + F.lit(len(token)), F.length(c))


def has(c: Column, token: str) -> Column:
    return F.instr(c, token) > 0


def contains_any(c: Column, *fragments: str) -> Column:
    """Whether any fragment occurs, ignoring case and respecting accents.

    One pattern search, instead of lowering the text once per fragment.
    """
    return c.rlike("(?iu)" + "|".join(f"\\Q{f}\\E" for f in fragments))


def replace_any_case(c: Column, token: str, by: str = "") -> Column:
    """REPLACE that ignores case, for a token of letters and digits."""
    if not token.isalnum():
        raise ValueError("token must be alphanumeric")
    return F.regexp_replace(c, f"(?i){token}", by)


def occurrence_number(c: Column, split: str = "-", with_tail="00", without_tail="01") -> Column:
    """Text before the split mark plus one suffix, or the whole text plus the other."""
    return F.when(has(c, split), F.concat(before_first(c, split), F.lit(with_tail))).otherwise(
        F.concat(c, F.lit(without_tail))
    )


def presence_label(c: Column, token: str, yes: str, no: str) -> Column:
    """Label by presence of a token; null counts as absent."""
    return F.when(has(c, token), F.lit(yes)).otherwise(F.lit(no))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def composite_key(*parts: Column, sep: str = "_") -> Column:
    """Joined key in which a missing part prints as ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])
