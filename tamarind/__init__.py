"""Business-analytics operators and reports written for Spark DataFrames."""

__version__ = "0.1.0"
