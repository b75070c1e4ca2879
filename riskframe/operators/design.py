"""Design matrix with explicit treatment contrasts."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.flags import with_levels
from riskframe.spec import FeatureSpec


def design_terms(spec: FeatureSpec) -> list[tuple[str, Column]]:
    """(term name, column) pairs: numbers as they are, one 0/1 column per non-reference level.

    A missing or undeclared category makes its columns null.
    """
    terms = [(c, F.col(c).cast("double")) for c in (*spec.numeric, *spec.binary)]
    for c, domain in spec.levels.items():
        known = with_levels(F.col(c), domain)
        for level in domain[1:]:
            hit = known == level
            terms.append((f"{c}{level}", F.when(hit, 1.0).when(~hit, 0.0)))
    return terms


def design_matrix(df: DataFrame, spec: FeatureSpec, keep=(), out: str = "features") -> DataFrame:
    """Feature vectors of the complete rows, with the kept columns."""
    parts = [c for _, c in design_terms(spec)]
    complete = F.lit(True)
    for c in (*spec.numeric, *spec.binary):
        complete &= F.col(c).isNotNull()
    for c, domain in spec.levels.items():
        complete &= F.col(c).isNotNull() & F.col(c).isin(*domain)
    return df.where(complete).select(*keep, array_to_vector(F.array(*parts)).alias(out))


def design_table(df: DataFrame, spec: FeatureSpec, keep=()) -> DataFrame:
    """The same matrix as plain columns named by term."""
    return df.select(*keep, *[c.alias(name) for name, c in design_terms(spec)])
