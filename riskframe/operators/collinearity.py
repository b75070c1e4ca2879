"""Variance inflation of the design columns, of the data or of a fitted model."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.design import design_matrix, design_table, design_terms
from riskframe.operators.glm import LogitFit
from riskframe.spec import FeatureSpec


def weighted_gram(df: DataFrame, spec: FeatureSpec, weight: Column) -> np.ndarray:
    """Sums of weight times products of the design terms, a constant first, over the complete rows.

    Each task adds up its own rows; terms times terms numbers of each task are
    merged by a shuffled sum, and the result is all that reaches the driver.
    """
    names = [name for name, _ in design_terms(spec)]
    rows = design_table(df.withColumn("_weight", weight), spec, keep=["_weight"]).dropna()

    def add_up(parts):
        total = np.zeros((len(names) + 1, len(names) + 1))
        for part in parts:
            x = np.column_stack([np.ones(len(part)), part[names].to_numpy(float)])
            total += x.T @ (x * part["_weight"].to_numpy(float)[:, None])
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    sums = rows.mapInPandas(add_up, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((len(names) + 1, len(names) + 1))
    for r in sums.collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def _estimates(df: DataFrame, fit: LogitFit, counts) -> tuple[np.ndarray, list[float | None]]:
    """Correlations of a fit's slopes, and their standard errors, at its own probabilities."""
    p = fit.scoring_expr()
    n = F.col(counts[0]).cast("double") if counts else F.lit(1.0)
    gram = weighted_gram(df, fit.spec, n * p * (1 - p))
    scale = np.sqrt(np.diag(gram))
    used = scale > 0
    size = len(gram) - 1
    corr, errors = np.full((size, size), np.nan), [None] * size
    if used[0]:
        ratio = gram[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        if np.linalg.cond(ratio) < 1e12:
            cov = np.linalg.inv(ratio) / np.outer(scale[used], scale[used])
            error = np.sqrt(np.diag(cov))
            at = np.flatnonzero(used)[1:] - 1
            corr[np.ix_(at, at)] = (cov / np.outer(error, error))[1:, 1:]
            for i, e in zip(at.tolist(), error[1:].tolist()):
                errors[i] = e
    return corr, errors


def vif(df: DataFrame, spec: FeatureSpec, fit: LogitFit | None = None, counts: tuple[str, str] | None = None) -> DataFrame:
    """VIF of every design term and generalised VIF of every predictor.

    Without ``fit`` the terms' own correlations are taken, every row alike.
    With a fitted logit, the correlations of its slopes are: rows weigh p(1 - p)
    at the fit's probabilities, and the standard errors come along.  ``counts`` names the
    row count column (and another) of a table of predictor combinations.

    One pass builds the matrix (terms x terms); the rest is algebra
    on that small matrix.  ``gvif_root`` is GVIF ** (1 / (2 * df)), comparable
    across predictors of different size.  Constant or fully collinear terms
    have no VIF and show null.
    """
    spark = df.sparkSession
    names = [name for name, _ in design_terms(spec)]
    owner = [*spec.numeric, *spec.binary]
    for c, domain in spec.levels.items():
        owner += [c] * (len(domain) - 1)
    if fit is None:
        corr = Correlation.corr(design_matrix(df, spec), "features").head()[0].toArray()
    else:
        corr, errors = _estimates(df, fit, counts)
    live = [i for i in range(len(names)) if not np.isnan(np.delete(corr[i], i)).all()]
    if len(names) == 1 and not (fit and np.isnan(corr).all()):
        live = [0]
    sub = corr[np.ix_(live, live)]
    sign, logdet = np.linalg.slogdet(sub)
    singular = not live or sign <= 0 or np.linalg.cond(sub) > 1e12
    term_vif = {} if singular else dict(zip(live, np.diag(np.linalg.inv(sub)).tolist()))
    rows = []
    for i, name in enumerate(names):
        own = [j for j in live if owner[j] == owner[i]]
        gvif, size = None, len(own)
        if not singular and i in live:
            rest = [j for j in live if owner[j] != owner[i]]
            _, inner = np.linalg.slogdet(corr[np.ix_(own, own)])
            outer = np.linalg.slogdet(corr[np.ix_(rest, rest)])[1] if rest else 0.0
            # Of one term the two are the same number, to the last digit only if taken once.
            gvif = term_vif[i] if size == 1 else math.exp(inner + outer - logdet)
        root = None if gvif is None else gvif ** (1 / (2 * size))
        rows.append((owner[i], name, term_vif.get(i), size, gvif, root))
    schema = "variable string, term string, vif double, df int, gvif double, gvif_root double"
    if fit is not None:
        rows, schema = [(*r, e) for r, e in zip(rows, errors)], f"{schema}, std_error double"
    return spark.createDataFrame(rows, schema)
