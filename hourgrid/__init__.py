"""Zone-hour mobility analytics on Spark DataFrames."""
