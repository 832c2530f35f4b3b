"""Mirror-flow reconciliation of bilateral trade statistics on Spark DataFrames."""

__version__ = "0.1.0"
