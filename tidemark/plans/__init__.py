"""The warehouse: each plan takes upstream DataFrames and returns one table."""
