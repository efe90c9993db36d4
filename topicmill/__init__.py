"""Topic classifiers for short text posts, built from Spark DataFrames."""

__version__ = "0.1.0"
