"""tidemark: early-trend analytics over text streams and tables, on Spark DataFrames."""

__version__ = "0.1.0"
