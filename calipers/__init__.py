"""Network-identity analytics on Spark DataFrames."""
