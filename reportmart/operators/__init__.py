"""Operators: DataFrames and parameters in, DataFrames out."""
