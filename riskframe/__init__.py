"""riskframe: tabular risk analytics expressed as Spark DataFrame plans."""

from riskframe.spec import FeatureSpec

__all__ = ["FeatureSpec"]
