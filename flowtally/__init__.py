"""Live-video traffic and quality accounting on Spark DataFrames."""

__version__ = "0.1.0"
