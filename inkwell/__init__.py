"""Spark-first engine for evidence-grounded document knowledge: every operator maps DataFrames to DataFrames."""

__version__ = "0.1.0"
