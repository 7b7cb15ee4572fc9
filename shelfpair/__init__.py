"""shelfpair: match product listings across shops with Spark DataFrames."""

__version__ = "0.1.0"
