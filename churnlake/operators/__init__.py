"""Operators: each one maps DataFrames to a DataFrame."""
