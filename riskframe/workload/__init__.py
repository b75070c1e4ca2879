"""Registered queries: every operator run on the given tables, beside its SQL check."""

from riskframe.workload.registry import REGISTRY, Query


def load_all() -> dict[str, Query]:
    """Import every query module once and return the registry."""
    from riskframe.workload import cleaning, loading, models, profiling, scorecard  # noqa: F401

    return REGISTRY
