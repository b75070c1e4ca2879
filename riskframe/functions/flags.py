"""Three-state flags, targets, ordered classification and score cutoffs."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.functions.numbers import at_least_one
from riskframe.functions.text import contains_any


def _blank(c: Column) -> Column:
    return F.trim(c) == ""


def presence_flag(c: Column) -> Column:
    """Count text to ``''`` (blank), ``'1'`` (one or more) or ``'0'`` (all else)."""
    return F.when(_blank(c), F.lit("")).when(at_least_one(c), F.lit("1")).otherwise(F.lit("0"))


def any_at_least_one(*counts: Column) -> Column:
    """Same three states over several counts: blank only if every one is blank."""
    return (
        F.when(reduce(and_, [_blank(c) for c in counts]), F.lit(""))
        .when(reduce(or_, [at_least_one(c) for c in counts]), F.lit("1"))
        .otherwise(F.lit("0"))
    )


def or_flag(a: Column, b: Column) -> Column:
    """1/0/null logical OR: null unless either side decides it."""
    return ((a == 1) | (b == 1)).cast("int")


def map_values(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """Value lookup; unmatched and null values take the default."""
    out = None
    for value, label in mapping.items():
        hit = c == value
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def classify(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    """First rule that holds gives the label."""
    if not rules:
        raise ValueError("classify needs at least one rule")
    (cond, label), *rest = rules
    out = F.when(cond, F.lit(label))
    for cond, label in rest:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def classify_contains(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Label by the first fragment found, in any letter case."""
    return classify([(contains_any(c, frag), label) for frag, label in rules], default)


def apply_cutoff(score: Column, cut: float | Column, strict: bool = True) -> Column:
    """1 above the cutoff (or at it, when not strict), 0 below, null if unscored."""
    limit = cut if isinstance(cut, Column) else F.lit(float(cut))
    hit = score > limit if strict else score >= limit
    return F.when(hit, 1).when(~hit, 0)


# Upper edges (closed) and names of the predictive-strength classes.
IV_CLASSES = ((0.02, "Fraquissimo"), (0.1, "Fraco"), (0.3, "Média"), (0.5, "Forte"))
IV_BEYOND = "Suspeita"


def iv_label(iv: Column) -> Column:
    """Strength class of an information value; null stays null."""
    return F.when(
        iv.isNotNull(), classify([(iv <= edge, name) for edge, name in IV_CLASSES], IV_BEYOND)
    )


def with_levels(c: Column, levels) -> Column:
    """Keep a category only if it belongs to the declared domain."""
    return F.when(c.isin(*levels), c)
