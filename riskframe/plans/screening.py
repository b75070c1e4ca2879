"""Screening of a study's predictors: evidence, selection, complete cases, collinearity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskframe.operators.collinearity import vif
from riskframe.operators.columns import complete_cases, drop_report
from riskframe.operators.woe import information_classes, iv_summary, select_features, woe_table
from riskframe.session import durable
from riskframe.spec import FeatureSpec


@dataclass(frozen=True)
class Screening:
    evidence: DataFrame
    decisions: DataFrame
    spec: FeatureSpec
    dropped: DataFrame
    collinearity: DataFrame
    model_table: DataFrame


def screen(
    df: DataFrame,
    spec: FeatureSpec,
    leakage=(),
    keep=(),
    breaks: dict[str, list] | None = None,
    weak: float = 0.1,
    suspicious: float = 0.5,
    bins: int = 10,
) -> Screening:
    """Choose predictors by information value and give what the choice costs.

    The decision log names every predictor; the complete cases of the kept ones
    come with the event rate of the rows they lose, and with the collinearity of
    what is kept (none below two predictors).
    """
    rows = durable(df)
    evidence = durable(
        woe_table(
            rows, spec.target, categorical=(*spec.levels, *spec.binary), numeric=spec.numeric,
            bins=bins, breaks=breaks,
        )
    )
    roles = (
        {c: "numeric" for c in spec.numeric} | {c: "categorical" for c in spec.levels} | {c: "binary" for c in spec.binary}
    )
    classes = information_classes(
        rows, spec.target, (*spec.levels, *spec.binary), spec.numeric, bins=bins, breaks=breaks
    )
    # One row per predictor.
    decisions = durable(
        select_features(
            iv_summary(evidence), roles, leakage=leakage, keep=keep, weak=weak, suspicious=suspicious, classes=classes
        )
    )
    gone = [r["variable"] for r in decisions.where("kept = 0").collect()]
    chosen = spec.without(*gone)
    names = [*chosen.predictors, spec.target]
    complete = complete_cases(rows, names)
    related = vif(complete, chosen) if len(chosen.predictors) > 1 else decisions.sparkSession.createDataFrame(
        [], "variable string, term string, vif double, df int, gvif double, gvif_root double"
    )
    return Screening(evidence, decisions, chosen, drop_report(rows, names, spec.target), related, complete)
