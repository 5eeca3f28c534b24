"""Daily time-series analytics on Spark DataFrames."""
