"""Reliability analytics for scheduled data pipelines, on Spark DataFrames."""

__version__ = "0.1.0"
