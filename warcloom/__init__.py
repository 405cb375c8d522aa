"""Spark operators for web-archive analytics: DataFrames in, DataFrames out."""

__version__ = "0.1.0"
