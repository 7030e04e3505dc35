"""lifeboat: tabular feature engineering and model selection on Spark DataFrames."""

__version__ = "0.1.0"
