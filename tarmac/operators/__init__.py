"""Operators: pure functions from DataFrames to a DataFrame, thresholds as keywords."""
