"""Time-coded media records as verified, queryable tables, on Spark DataFrames."""
