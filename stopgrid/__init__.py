"""Transit demand and operations analytics on Spark DataFrames."""
