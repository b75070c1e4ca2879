"""Model monitoring on the live table: refit, in-sample metrics, one record."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.columns import align_levels, unlisted_levels
from riskframe.operators.glm import PATTERN_COUNTS, LogitFit, covariate_patterns, fit_logit
from riskframe.operators.metrics import evaluate
from riskframe.operators.profile import latest
from riskframe.plans.crash_schema import MONITORING_SCHEMA
from riskframe.session import durable
from riskframe.sources.writers import append_record
from riskframe.spec import FeatureSpec


def latest_baseline(baselines: DataFrame) -> DataFrame:
    """The most recently trained baseline row."""
    return latest(baselines, "data_treinamento")


@dataclass(frozen=True)
class MonitorRun:
    record: dict
    fit: LogitFit
    n_unscored: int
    unlisted: DataFrame
    baseline: dict
    ks: float | None
    ks_grouped: float | None


def monitor(
    live: DataFrame,
    baselines: DataFrame,
    spec: FeatureSpec,
    target_path: str | None = None,
    load_id: str = "carga_id",
    empty_metric: str = "zero",
    run_at: datetime | None = None,
    collapse: bool = True,
    stored_ks: str = "ks",
    auto_direction: bool | str = False,
) -> MonitorRun:
    """Refit on the whole live table and measure it there at the baseline cutoff.

    Metrics are computed over scored rows.  ``empty_metric='zero'`` stores an
    undefined metric as 0, ``'null'`` keeps it null.  The number of unscored
    rows and the categories outside the declared levels are reported, and a fit
    that did not converge is warned about.  ``stored_ks`` names the KS of the
    record, ``ks`` or ``ks_grouped``: the one the baseline was recorded with.
    """
    if stored_ks not in ("ks", "ks_grouped"):
        raise ValueError("stored_ks must be 'ks' or 'ks_grouped'")
    if empty_metric not in ("zero", "null"):
        raise ValueError("empty_metric must be 'zero' or 'null'")
    found = latest_baseline(baselines).collect()
    if not found:
        raise ValueError("no baseline row")
    baseline = found[0].asDict()
    cut = baseline["cutoff"]
    facts = live.agg(F.count("*").alias("n"), F.max(load_id).alias("load")).first()
    aligned = align_levels(live, spec)
    if collapse:
        # Fit and metrics share one table of predictor combinations and counts.
        rows, counts = durable(covariate_patterns(aligned, spec)), PATTERN_COUNTS
    else:
        rows, counts = aligned, None
    fit = fit_logit(rows, spec, collapse=False, counts=counts)
    if not fit.converged:
        warnings.warn(f"the refit did not converge in {fit.iterations} iterations", stacklevel=2)
    threshold = float("inf") if cut is None else cut
    measured = evaluate(
        fit.score(rows), spec.target, "probability", threshold, "live", counts=counts,
        auto_direction=auto_direction,
    ).first()
    n_scored = sum(measured[c] or 0 for c in ("tp", "fp", "fn", "tn"))

    def stored(value):
        return 0.0 if value is None and empty_metric == "zero" else value

    record = {
        "carga_id": facts.load,
        "data_execucao": (run_at or datetime.now()).strftime("%Y-%m-%d %H:%M:%S"),
        "n_linhas_base_viva": facts.n,
        "auc_viva": stored(measured.auc),
        "ks_viva": stored(measured[stored_ks]),
        "sensibilidade_viva": stored(None if cut is None else measured.sensitivity),
        "cutoff_usado": stored(cut),
    }
    if target_path:
        append_record(live.sparkSession, record, MONITORING_SCHEMA, target_path)
    return MonitorRun(
        record, fit, facts.n - n_scored, unlisted_levels(live, spec), baseline,
        measured.ks, measured.ks_grouped,
    )
