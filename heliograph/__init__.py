"""Research-activity analytics on Spark DataFrames."""
