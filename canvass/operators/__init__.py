"""Operators: DataFrames in, DataFrames out; columns, lists and thresholds are arguments."""
