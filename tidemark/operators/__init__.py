"""Distributed operators the DataFrame API has no single call for."""
