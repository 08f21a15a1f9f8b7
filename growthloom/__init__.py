"""Growth analytics operators on Spark DataFrames."""
