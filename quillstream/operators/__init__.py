"""Operators on DataFrames, from parsing to the index."""
