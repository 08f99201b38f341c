"""gridweave: power-network analytics on Spark DataFrames."""
