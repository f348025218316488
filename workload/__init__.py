"""Queries and oracles over the driver's parquet tables."""
