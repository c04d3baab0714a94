"""Operators: each a function of DataFrames, column names and parameters."""
