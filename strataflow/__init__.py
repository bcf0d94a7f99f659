"""Bronze / silver / gold feature and scoring pipelines on Spark DataFrames."""

from strataflow.spec import FeatureSpec, Layers, TableFormat

__all__ = ["FeatureSpec", "Layers", "TableFormat"]
