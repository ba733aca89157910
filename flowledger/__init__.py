"""Monthly production-series analytics on Spark DataFrames."""
