"""Article quality analytics on Spark DataFrames."""
