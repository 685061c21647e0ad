"""Queries over traces: each takes DataFrames and returns a lazy DataFrame."""
