"""Unregularised logistic regression with inference, scored as an expression."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.errors import UnsupportedOperationException
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.design import design_matrix, design_terms
from riskframe.session import durable
from riskframe.spec import FeatureSpec

INTERCEPT = "(Intercept)"
PATTERN_COUNTS = ("_n", "_n1")
#: What the library says when the fit has no standard errors.
NO_INFERENCE = "No Std. Error"


@dataclass(frozen=True)
class LogitFit:
    spec: FeatureSpec
    terms: tuple[str, ...]
    coefficients: tuple[float, ...]
    std_errors: tuple[float, ...] | None
    z_values: tuple[float, ...] | None
    p_values: tuple[float, ...] | None
    deviance: float
    aic: float
    rows: int
    iterations: int
    converged: bool

    def coef_table(self, spark: SparkSession) -> DataFrame:
        """Term, estimate, standard error, z and p, intercept first."""
        blank = (None,) * len(self.terms)
        rows = zip(
            self.terms,
            self.coefficients,
            self.std_errors or blank,
            self.z_values or blank,
            self.p_values or blank,
        )
        return spark.createDataFrame(
            [tuple(r) for r in rows],
            "term string, estimate double, std_error double, z double, p double",
        )

    def linear_predictor(self) -> Column:
        parts = dict(design_terms(self.spec))
        slopes = [
            parts[t] * F.lit(b) for t, b in zip(self.terms[1:], self.coefficients[1:])
        ]
        return reduce(add, slopes, F.lit(self.coefficients[0]))

    def scoring_expr(self) -> Column:
        """P(target = 1) as a column; null wherever a predictor is missing."""
        return 1 / (1 + F.exp(-self.linear_predictor()))

    def score(self, df: DataFrame, out: str = "probability") -> DataFrame:
        return df.withColumn(out, self.scoring_expr())

    def equation(self) -> str:
        """The fitted linear predictor as text."""
        terms = [f"{b:+.6g}*{t}" for t, b in zip(self.terms[1:], self.coefficients[1:])]
        return f"logit(p) = {self.coefficients[0]:.6g} " + " ".join(terms)


def covariate_patterns(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Distinct predictor combinations with their rows ``_n`` and events ``_n1``.

    The likelihood depends on the rows only through these counts, so every
    iteration runs over the patterns instead of the rows.
    """
    usable = df.where(F.col(spec.target).isNotNull())
    return usable.groupBy(*spec.predictors).agg(
        F.count("*").alias("_n"), F.sum(F.col(spec.target).cast("double")).alias("_n1")
    )


def _saturated_deviance() -> Column:
    """Bernoulli deviance that remains when each pattern is fitted by its own rate."""
    n, n1 = F.col("weight"), F.col("weight") * F.col("label")

    def part(count):
        return F.when(count > 0.5, count * F.ln(count / n)).otherwise(0.0)

    return F.sum(-2 * (part(n1) + part(n - n1)))


def fit_logit(
    df: DataFrame,
    spec: FeatureSpec,
    collapse: bool = True,
    max_iter: int = 25,
    tol: float = 1e-8,
    counts: tuple[str, str] | None = None,
) -> LogitFit:
    """Binomial regression with logit link.

    ``collapse`` groups equal covariate patterns first (events out of trials),
    which pays off for counts and categories; switch it off for continuous
    predictors, where nearly every row is its own pattern.  ``counts`` names the
    row and event count columns of a table that is grouped already.
    """
    if counts or collapse:
        source = df if counts else covariate_patterns(df, spec)
        n, n1 = counts or PATTERN_COUNTS
        label, weight = F.col(n1) / F.col(n), F.col(n)
    else:
        source = df.where(F.col(spec.target).isNotNull())
        label, weight = F.col(spec.target), F.lit(1)
    kept = [label.cast("double").alias("label"), weight.cast("double").alias("weight")]
    rows = durable(design_matrix(source, spec, keep=kept))
    model = GeneralizedLinearRegression(
        family="binomial",
        link="logit",
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=max_iter,
        tol=tol,
    ).fit(rows)
    terms = (INTERCEPT, *[name for name, _ in design_terms(spec)])
    coefficients = (model.intercept, *model.coefficients.toArray().tolist())
    summary = model.summary
    spread = {}
    try:
        for name, values in (
            ("std_errors", summary.coefficientStandardErrors),
            ("z_values", summary.tValues),
            ("p_values", summary.pValues),
        ):
            # The library lists the intercept last.
            spread[name] = (values[-1], *values[:-1])
    except UnsupportedOperationException as error:
        # A singular information matrix has no standard errors; any other failure is one.
        if NO_INFERENCE not in str(error):
            raise
        spread = dict.fromkeys(("std_errors", "z_values", "p_values"))
    # AIC over single rows, from the grouped deviance and the part lost by
    # grouping; the built-in AIC keeps trial counts as 32-bit integers.
    facts = rows.agg(F.sum("weight").alias("n"), _saturated_deviance().alias("saturated")).first()
    deviance = summary.deviance + (facts.saturated or 0.0)
    return LogitFit(
        spec=spec,
        terms=terms,
        coefficients=coefficients,
        deviance=deviance,
        aic=deviance + 2 * len(terms),
        rows=int(facts.n or 0),
        iterations=summary.numIterations,
        # The count stands at the limit both if the last step converged and if none did.
        converged=summary.numIterations < max_iter or _settled(model, rows, tol),
        **spread,
    )


def _settled(model, rows: DataFrame, tol: float) -> bool:
    """Whether one more step from the coefficients found changes them by less than ``tol``."""
    again = model.summary.deviance
    longer = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="features", labelCol="label", weightCol="weight",
        maxIter=model.summary.numIterations + 1, tol=tol,
    ).fit(rows)
    return abs(longer.summary.deviance - again) <= tol * (abs(again) + 0.1)


def compare_models(spark: SparkSession, fits: dict[str, LogitFit]) -> DataFrame:
    """Model, terms, deviance and AIC, with the predictors each one lacks."""
    everything = [p for f in fits.values() for p in f.spec.predictors]
    full = list(dict.fromkeys(everything))
    rows = [
        (
            name,
            len(f.terms),
            ",".join(p for p in full if p not in f.spec.predictors),
            f.deviance,
            f.aic,
            f.converged,
        )
        for name, f in fits.items()
    ]
    return spark.createDataFrame(
        rows, "model string, terms int, dropped string, deviance double, aic double, converged boolean"
    )
