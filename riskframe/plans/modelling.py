"""Model table to fitted models, cutoffs and the comparison table."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import chaid, glm
from riskframe.operators.metrics import Sample, best_cutoff, evaluate_all
from riskframe.operators.split import exact_split
from riskframe.session import durable
from riskframe.spec import FeatureSpec


@dataclass(frozen=True)
class Study:
    logit: glm.LogitFit
    tree: chaid.ChaidTree
    cutoffs: DataFrame
    comparison: DataFrame
    train: DataFrame
    test: DataFrame


def run_study(
    model_table: DataFrame,
    spec: FeatureSpec,
    frac: float = 0.8,
    seed: int = 42,
    criterion: str = "youden",
    max_height: int = 4,
) -> Study:
    """Split, fit logit and tree on the training part, choose cutoffs, compare on both parts."""
    table = durable(model_table)
    train, test = exact_split(table, spec.key, frac, seed)
    y, counts = spec.target, glm.PATTERN_COUNTS
    # Scores depend on the predictors alone, so after these two aggregates
    # everything runs on distinct predictor combinations and their counts.
    grouped_train, grouped_test = (
        durable(glm.covariate_patterns(part, spec)) for part in (train, test)
    )
    logit = glm.fit_logit(grouped_train, spec, counts=counts)
    if not logit.converged:
        warnings.warn(f"the fit did not converge in {logit.iterations} iterations", stacklevel=2)
    tree = chaid.fit_chaid(
        grouped_train, y, spec.predictors, max_height=max_height, counts=counts
    )

    def scored(df):
        return chaid.tree_score(logit.score(df), tree, p0="tree_p0", p1="tree_p1")

    parts = {"train": grouped_train, "test": grouped_test}
    labelled = [
        scored(part).select(*counts, "probability", "tree_p1", F.lit(name).alias("_part")) for name, part in parts.items()
    ]
    both = durable(labelled[0].unionByName(labelled[1]))
    on_train = both.where(F.col("_part") == "train")
    criteria = ("abs_d_sens_spec", "accuracy", "f1", "youden")
    # Four rows, kept so the cutoff in use and the report are the same numbers.
    cutoffs = durable(best_cutoff(on_train, y, "probability", *criteria, counts=counts))
    logit_cut = cutoffs.where(F.col("metric") == criterion).first().cutoff
    tree_cut = tree.root.n1 / tree.root.n

    samples = [
        Sample(f"{model}/{name}", score, cut, strict, F.col("_part") == name)
        for model, score, cut, strict in (("logit", "probability", logit_cut, True), ("chaid", "tree_p1", tree_cut, False))
        for name in parts
    ]
    comparison = evaluate_all(both, y, samples, counts=counts)
    return Study(logit, tree, cutoffs, comparison, scored(train), scored(test))
