"""Point-of-interest conflation on Spark DataFrames."""
